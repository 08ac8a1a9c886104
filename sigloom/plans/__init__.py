"""sigloom.plans"""
