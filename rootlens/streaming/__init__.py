"""No streaming operators: the analysed workload is a daily batch job with no
stream source, watermark or stateful logic, so there is nothing to express here."""
