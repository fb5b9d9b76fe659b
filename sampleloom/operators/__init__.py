"""sampleloom.operators"""
