"""meterflow.streaming"""
