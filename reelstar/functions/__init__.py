"""reelstar.functions"""
