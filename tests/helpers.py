from pyspark.sql import types as T

from sieveflow.sources.messages import normalize_messages, with_fingerprint

RAW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("channel_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("seq", T.LongType()),
])


def msgs(spark, rows, ingest_time="2024-01-01 00:00:00"):
    """rows: (id, channel_id, text) or (id, channel_id, channel, text);
    list order is the arrival order."""
    data = []
    for i, r in enumerate(rows, start=1):
        if len(r) == 3:
            mid, ch, text = r
            name = ch
        else:
            mid, ch, name, text = r
        data.append((None if mid is None else str(mid), ch, name, text, i))
    df = spark.createDataFrame(data, RAW_SCHEMA)
    return with_fingerprint(normalize_messages(df, ingest_time=ingest_time))


def statuses(df, seq="seq"):
    return {r[seq]: r["status"] for r in df.select(seq, "status").collect()}
