"""Column layouts the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
FLOATS, LONGS, DOUBLES = T.ArrayType(T.FloatType()), T.ArrayType(LONG), T.ArrayType(DOUBLE)


def layout(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# The metadata columns kept with every vector, in file order.
METADATA = layout(
    caption=STRING,
    NSFW=STRING,
    similarity=DOUBLE,
    width=LONG,
    height=LONG,
    original_width=LONG,
    original_height=LONG,
    md5=STRING,
)

BARE_VECTORS = layout(pk=LONG, float32_vector=FLOATS)
FULL_VECTORS = T.StructType(
    layout(pk=LONG, pk_5b=LONG).fields + METADATA.fields + layout(float32_vector=FLOATS).fields
)
QUERIES = layout(qid=LONG, vector=FLOATS)
NEIGHBORS = layout(qid=LONG, rank=INT, id=LONG, distance=DOUBLE)
NEIGHBORS_WIDE = layout(id=LONG, neighbors_id=LONGS, distance=DOUBLES)
MANIFEST = layout(
    shard=STRING, shard_no=INT, n_rows=LONG, pk_start=LONG, pk_global_start=LONG, status=STRING
)
LATENCY = layout(seq=LONG, cost_ms=DOUBLE)
