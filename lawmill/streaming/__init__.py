"""lawmill.streaming"""
