import json

from autopulse.cli import main

print(json.dumps(main(), default=str))
