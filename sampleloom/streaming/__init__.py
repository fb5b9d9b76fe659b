"""sampleloom.streaming"""
