"""sigloom.functions"""
