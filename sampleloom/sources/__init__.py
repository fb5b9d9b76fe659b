"""sampleloom.sources"""
