"""reelstar.sources"""
