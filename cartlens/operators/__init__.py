"""cartlens.operators"""
