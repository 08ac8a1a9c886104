"""sigloom.streaming"""
