"""sigloom.operators"""
