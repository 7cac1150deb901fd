"""lawmill.sources"""
