"""autopulse.streaming"""
