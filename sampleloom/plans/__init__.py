"""sampleloom.plans"""
