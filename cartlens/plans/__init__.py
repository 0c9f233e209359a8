"""cartlens.plans"""
