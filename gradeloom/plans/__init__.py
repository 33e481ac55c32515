"""gradeloom.plans"""
