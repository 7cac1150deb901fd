"""lawmill.plans"""
