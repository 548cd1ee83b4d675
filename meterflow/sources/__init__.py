"""meterflow.sources"""
