"""gridcast.operators"""
