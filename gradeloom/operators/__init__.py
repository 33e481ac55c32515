"""gradeloom.operators"""
