"""reelstar.plans"""
