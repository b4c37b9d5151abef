"""Operators for preparing training text: deduplication, decontamination,
safety and quality filters, scoring and tokenization, as Spark jobs."""
