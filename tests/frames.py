"""Small hand-made source rows; columns not given are NULL."""

from __future__ import annotations

from pyspark.sql import functions as F

from watchlytics.schemas import TABLES, spark_type


def frame(spark, table, *records):
    """Rows of one of the nine tables; texts are cast to the declared types."""
    types = {c: spark_type(t) for c, t in TABLES[table].items()} | {"_loaded_at": "timestamp_ntz"}
    data = [tuple(None if r.get(c) is None else str(r[c]) for c in types) for r in records]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in types))
    return df.select(
        *(F.from_json(c, t).alias(c) if t.startswith("array") else F.col(c).cast(t).alias(c) for c, t in types.items())
    )


def session(id, user_id=1, content_id=1, start="2024-01-10 10:00:00", seconds=60, rate="50.00", **more):
    return dict(
        id=id, user_id=user_id, content_id=content_id, session_start=start, duration_seconds=seconds,
        completion_rate=rate, **more,
    )


def user(id, **more):
    names = {"username": f"u{id}", "email": f"u{id}@x", "first_name": "A", "last_name": "B", "country": "fra"}
    return dict(id=id, **{**names, **more})


def title(id, **more):
    return dict(id=id, **{"title": f"t{id}", "content_type": "movie", "genre": "g", "duration_minutes": 90, **more})
