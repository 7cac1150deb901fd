"""lawmill.operators"""
