"""The derived tables: the same rows however the events' files are cut."""

import collections
import datetime as dt
import random

from auditlens.functions.text import flatten_for_compare
from auditlens.sources import load_test_tables
from auditlens.sources import tables as S

START = dt.datetime(2024, 1, 1)


def rows_of(df):
    return collections.Counter(tuple(r) for r in flatten_for_compare(df).collect())


def test_one_large_row_group_is_dealt_over_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "TASK_EVENTS", 100, raising=False)
    rng = random.Random(3)
    rows = [(i, START + dt.timedelta(seconds=rng.randrange(10**6)), rng.randrange(30)) for i in range(1500)]
    rows += [(7, START, 1)] * 5 + [(None, START, 2), (8, None, 3), (9, START, None)] * 2
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long").coalesce(1).write.parquet(
        f"{tmp_path}/events.parquet")
    for name in ("nation", "region", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    got, plain = load_test_tables(spark, str(tmp_path)), S.derive_test_tables(spark, str(tmp_path))
    for name in ("audit", "history"):
        df = getattr(got, name)
        assert rows_of(df) == rows_of(getattr(plain, name))
        files = collections.Counter(r[0] for r in df.select("_metadata.file_path").collect())
        assert len(files) > 10 and max(files.values()) < 600
