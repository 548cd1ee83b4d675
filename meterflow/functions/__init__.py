"""meterflow.functions"""
