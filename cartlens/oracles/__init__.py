"""cartlens.oracles"""
