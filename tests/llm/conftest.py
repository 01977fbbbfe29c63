from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def documents(sf_dir):
    """The small documents table as (doc_id, text, source) tuples."""
    import pyarrow.parquet as pq

    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text", "source"])
    return list(zip(*(table[c].to_pylist() for c in table.column_names), strict=True))
