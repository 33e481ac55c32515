"""gradeloom.streaming"""
