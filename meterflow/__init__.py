"""meterflow: utility-metering analytics as Spark DataFrame operators."""
