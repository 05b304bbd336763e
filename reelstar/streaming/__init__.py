"""reelstar.streaming"""
