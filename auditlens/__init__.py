"""auditlens: audit-log detection rules, findings and reports as Spark jobs."""

__version__ = "0.1.0"
