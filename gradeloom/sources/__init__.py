"""gradeloom.sources"""
