"""autopulse: vehicle-telemetry analytics as PySpark DataFrame and Structured Streaming operators.

Every operator takes and returns a DataFrame (batch or streaming) and keeps its
work on executors; nothing is collected to the driver.
"""

__version__ = "0.1.0"
