"""meterflow.plans"""
