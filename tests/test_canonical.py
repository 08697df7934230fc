"""Canonical JSON against the standard library."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from panelforge.functions.canonical import canonical_json

SCHEMA = "v struct<z:double, a:string, m:map<string,struct<y:long,b:boolean>>, l:array<struct<q:string,p:double>>, `we\"ird`:int, d:date, t:timestamp>"


def test_values_of_any_shape(spark):
    rng = random.Random(3)
    doubles = [0.0, -0.0, 1.0, -2.5, 1e16, 1e15, 123456789.0, 9999999.0, 1e7, 1.5e-5, 1e-4, 0.00012, 0.001, 3.25e-7, 6.02e23, -1.25e300, 0.1, 2.0**53, None]
    doubles += [rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 20) for _ in range(300)]
    texts = ["", "plain", 'q"uo\\te', "tab\tnew\nline\r\b\f", "\x00\x01\x1f\x7f", "é中😀 ", None]
    rows = []
    for i, x in enumerate(doubles):
        m = None if i % 7 == 0 else {k: None if i % 5 == 0 else {"y": i * 10**12, "b": i % 2 == 0} for k in ("b", "a", "Z", "é")[: i % 5]}
        items = None if i % 6 == 0 else [None if j == 2 else {"q": rng.choice(texts), "p": rng.choice(doubles)} for j in range(i % 4)]
        rows.append(None if i % 41 == 40 else {"z": x, "a": texts[i % len(texts)], "m": m, "l": items, 'we"ird': i, "d": dt.date(2024, 1, 1 + i % 28), "t": dt.datetime(2024, 1, 1, 0, 0, i % 60, 1000 if i % 2 else 0)})
    df = spark.createDataFrame([(r,) for r in rows], SCHEMA).coalesce(1)
    got = [r[0] for r in df.select(canonical_json(df, "v")).collect()]

    def plain(v):
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        if isinstance(v, list):
            return [plain(x) for x in v]
        if isinstance(v, dt.datetime):
            return v.replace(tzinfo=dt.timezone.utc).isoformat()
        return v.isoformat() if isinstance(v, dt.date) else v

    want = [json.dumps(plain(r), sort_keys=True, separators=(",", ":"), ensure_ascii=False) for r in rows]
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    # Java before 19 shows some doubles with a digit too many; they still name the same value
    assert all(json.loads(g) == json.loads(w) for g, w in differing) and len(differing) < len(rows) / 10


def test_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert df.select(F.sha2(canonical_json(df, "v"), 256)).count() == 0
