"""autopulse.plans"""
