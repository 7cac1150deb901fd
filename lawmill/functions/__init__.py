"""lawmill.functions"""
