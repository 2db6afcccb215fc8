"""gridcast.functions"""
