"""meterflow.operators"""
