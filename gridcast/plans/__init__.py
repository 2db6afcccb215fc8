"""gridcast.plans"""
