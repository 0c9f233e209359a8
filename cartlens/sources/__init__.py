"""cartlens.sources"""
