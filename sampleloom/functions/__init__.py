"""sampleloom.functions"""
