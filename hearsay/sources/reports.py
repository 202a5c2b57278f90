"""Report sinks: one folder per report section."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_sections(sections: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Write each section to `<folder>/<section>`, replacing an older report."""
    for name, frame in sections.items():
        writer = frame.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True).option("escape", '"')
        writer.save(f"{folder}/{name}")
