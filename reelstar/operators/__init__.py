"""reelstar.operators"""
