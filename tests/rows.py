"""Small helpers to build and read rows in tests."""

import json

VOTE = "id string, stream bigint, state string, party string, event_us bigint, arrival_us bigint"


def votes(spark, rows):
    """Votes from (state, party, event_us[, arrival_us[, stream]]) tuples."""
    full = []
    for i, row in enumerate(rows):
        state, party, event_us, *more = row
        arrival_us = more[0] if more else event_us
        stream = more[1] if len(more) > 1 else 1
        full.append((f"{stream}-{i}", stream, state, party, event_us, arrival_us))
    return spark.createDataFrame(full, VOTE)


def line(**fields):
    return json.dumps(fields)


def lines(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def tuples(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
