"""gridcast.sources"""
