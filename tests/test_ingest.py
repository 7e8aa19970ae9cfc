"""Ingest: file scan, message build, base64/JSON round trips, first-wins, malformed messages."""

import base64
import hashlib
import json
import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakelens.config import JobConfig
from lakelens.functions import binary, jsonval, timefmt
from lakelens.operators import ingest, metadata
from lakelens.operators.ids import assign_serial_ids
from lakelens.sources.files import image_folder


@settings(max_examples=10, deadline=None)
@given(st.lists(st.binary(max_size=300), min_size=1, max_size=20))
def test_base64_and_hash_match_python(spark, blobs):
    df = spark.createDataFrame([(bytearray(b),) for b in blobs], "content binary")
    rows = df.select(binary.base64_text(F.col("content")).alias("b"), binary.sha256_hex(F.col("content")).alias("h"),
                     binary.decode_base64(binary.base64_text(F.col("content"))).alias("d")).collect()
    for blob, r in zip(blobs, rows):
        assert r["b"] == base64.b64encode(blob).decode()
        assert r["h"] == hashlib.sha256(blob).hexdigest()
        assert bytes(r["d"]) == blob


def test_base64_decodable_rules(spark):
    cases = {"YWJj": True, "YWI=": True, "YQ==": True, "abc": False, "YW=Jj": False, "YW Jj\n": True, "": True}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r["t"]: r["ok"] for r in df.select("t", binary.base64_decodable(F.col("t")).alias("ok")).collect()}
    assert got == cases


def test_iso_format_and_parse(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' a, timestamp_ntz'2024-01-01 00:00:00.5' b")
    r = df.select(timefmt.iso_naive(F.col("a")).alias("a"), timefmt.iso_naive(F.col("b")).alias("b")).first()
    assert (r["a"], r["b"]) == ("2024-01-01T00:00:00", "2024-01-01T00:00:00.500000")
    texts = ["2024-01-01T00:00:00", "2024-01-01T02:00:00+02:00", "2024-01-01 00:00:00Z", "yesterday", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        timefmt.parse_iso_utc(F.col("t")).cast("string").alias("p")).collect()
    assert [r["p"] for r in rows] == ["2024-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-01 00:00:00", None, None]


def test_json_truthiness_and_dynamic_types(spark):
    values = ['{"file_hash":"abc","file_size":"12"}', '{"file_hash":"","file_size":"x"}', '{"file_hash":null}',
              '{"file_hash":0}', '{"file_hash":false}', '{"file_hash":7}', "[1,2]", "not json"]
    df = spark.createDataFrame([(v,) for v in values], "value string").withColumn("v", jsonval.parse(F.col("value")))
    rows = df.select(jsonval.is_truthy(F.col("v"), "file_hash").alias("t"), jsonval.get_long(F.col("v"), "file_size").alias("s"),
                     jsonval.is_object(F.col("v")).alias("o"), jsonval.has_field(F.col("v"), "file_size").alias("h")).collect()
    assert [r["t"] for r in rows] == [True, False, False, False, False, True, False, False]
    assert [r["s"] for r in rows][:2] == [12, None]
    assert [r["o"] for r in rows] == [True] * 6 + [False, False]
    assert [r["h"] for r in rows][:3] == [True, True, False]


def _envelopes(spark, values):
    rows = [(f"k{i}", v, "image-uploads", i % 3, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, "
                                       "timestamp timestamp_ntz")


def test_malformed_messages_strict_and_lenient(spark):
    good = {"filename": "a.jpg", "filepath": "/d/a.jpg", "file_size": 3, "file_hash": "h" * 64,
            "mime_type": "image/jpeg", "timestamp": "2024-01-01T00:00:00", "image_data": "YWJj"}

    def variant(**kw):
        m = dict(good)
        for k, v in kw.items():
            if v is KeyError:
                m.pop(k)
            else:
                m[k] = v
        return json.dumps(m)

    values = [variant(), variant(filename=KeyError), variant(filename="f" * 256), variant(file_hash="h" * 65),
              variant(mime_type="m" * 51), variant(timestamp="bad"), variant(image_data="abc"),
              variant(file_size="12"), variant(file_size="x"), variant(mime_type=KeyError),
              variant(timestamp=KeyError), variant(timestamp="2024-01-01T00:00:00+02:00"), "[1,2]", "not json"]
    parsed = ingest.parse_messages(_envelopes(spark, values))
    now = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    lenient = [r["reason"] for r in metadata.validate_messages(parsed, strict=False, now=now).orderBy("offset").collect()]
    strict = [r["reason"] for r in metadata.validate_messages(parsed, strict=True, now=now).orderBy("offset").collect()]
    assert lenient == [None, "missing_filename", "filename_too_long", "file_hash_too_long", "mime_type_too_long",
                       "bad_timestamp", "bad_image_data", None, "bad_file_size", None, None, None,
                       "not_object", "invalid_json"]
    assert strict[9] == "missing_mime_type" and strict[10] == "missing_timestamp"
    assert strict[7] is None and strict[11] is None
    small = metadata.validate_messages(parsed, strict=False, now=now, max_bytes=100).where(
        F.col("reason") == "payload_too_large").count()
    assert small >= 10


def test_first_wins_is_idempotent_under_replay(spark):
    rows = spark.createDataFrame(
        [("h1", "a.jpg", 1, 0, 5), ("h1", "b.jpg", 1, 1, 2), ("h2", "c.jpg", 2, 0, 9)],
        "file_hash string, filename string, kafka_timestamp long, kafka_partition int, kafka_offset long")
    target = spark.createDataFrame([(10, "h0")], "id long, file_hash string")
    first = metadata.insert_first_wins(rows, target)
    got = sorted((r["id"], r["file_hash"], r["filename"]) for r in first.collect())
    assert got == [(11, "h1", "a.jpg"), (12, "h2", "c.jpg")]
    again = metadata.insert_first_wins(rows, target.unionByName(first.select("id", "file_hash")))
    assert again.count() == 0


def test_serial_ids_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5000).alias("k"))
    out = assign_serial_ids(df, ["k"], 100).collect()
    pairs = sorted((r["k"], r["id"]) for r in out)
    assert [p[1] for p in pairs] == list(range(101, 5101))


def test_folder_scan_and_messages(spark, scratch):
    names = {"b.JPG": b"\xff\xd8beta", "a.png": b"alpha", "c.txt": b"not an image", ".hidden.jpg": b"x"}
    for name, data in names.items():
        with open(os.path.join(scratch, name), "wb") as fh:
            fh.write(data)
    os.mkdir(os.path.join(scratch, "sub.jpg"))
    files = image_folder(spark, scratch)
    msgs = ingest.build_messages(files, F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")).orderBy("filename").collect()
    assert [m["filename"] for m in msgs] == ["a.png", "b.JPG"]
    assert msgs[1]["mime_type"] == "image/jpeg" and msgs[0]["mime_type"] == "image/png"
    assert msgs[0]["file_hash"] == hashlib.sha256(b"alpha").hexdigest()
    assert base64.b64decode(msgs[1]["image_data"]) == b"\xff\xd8beta"
    assert msgs[0]["filepath"] == os.path.join(scratch, "a.png")
    assert msgs[0]["timestamp"] == "2024-01-01T10:00:00"
    assert image_folder(spark, os.path.join(scratch, "missing")).count() == 0


def test_envelope_size_split(spark):
    msgs = spark.createDataFrame([("a.jpg", "/a.jpg", 1, "h", "image/jpeg", "t", "x" * 50)],
                                 "filename string, filepath string, file_size long, file_hash string, "
                                 "mime_type string, timestamp string, image_data string")
    env = ingest.to_envelopes(msgs, JobConfig().input_topic)
    ok, big = ingest.split_by_size(env, 100)
    assert ok.count() == 0 and big.count() == 1
    ok, big = ingest.split_by_size(env, 10_000)
    back = ingest.parse_messages(ok).first()
    assert back["file_hash"] == "h" and back["image_data"] == "x" * 50


def test_orphan_objects_after_retention(spark):
    meta = spark.createDataFrame([(1, "images/2024/01/01/a.jpg", "2024-01-01 00:00:00"),
                                  (2, "images/2024/03/01/b.jpg", "2024-03-01 00:00:00")],
                                 "id long, s3_path string, uploaded_at string") \
        .withColumn("uploaded_at", F.col("uploaded_at").cast("timestamp_ntz"))
    objs = spark.createDataFrame([("images/2024/01/01/a.jpg",), ("images/2024/03/01/b.jpg",)], "object_key string")
    kept = metadata.retention_delete(meta, "2024-03-15")
    assert [r["object_key"] for r in metadata.orphan_objects(objs, kept).collect()] == ["images/2024/01/01/a.jpg"]


def test_anti_join_paths_agree(spark):
    from lakelens.operators.joins import anti_join_keys
    rows = spark.range(0, 300).select((F.col("id") % 50).cast("string").alias("k"), "id") \
        .unionByName(spark.createDataFrame([(None, 999)], "k string, id long"))
    target = spark.range(0, 20).select((F.col("id") * 2).cast("string").alias("k"))
    def run(**kw):
        return sorted((tuple(r) for r in anti_join_keys(rows, target, "k", **kw).collect()), key=str)

    plain = run()
    assert plain == run(probe=True) == run(probe=True, max_broadcast_bytes=30)
    assert (None, 999) in plain


def test_processed_rows_too_long_are_quarantined(spark):
    from lakelens.operators import processed
    rows = spark.createDataFrame([("h" * 64, "a.jpg", "image/jpeg"), ("h" * 65, "b.jpg", "image/jpeg"),
                                  ("g" * 64, "f" * 256, "image/jpeg"), ("k" * 64, "c.jpg", "m" * 101)],
                                 "file_hash string, filename string, mime_type string")
    fits, too_long = processed.split_t2_limits(rows)
    assert [r["filename"] for r in fits.collect()] == ["a.jpg"] and too_long.count() == 3


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=60), st.lists(st.integers(1, 59), max_size=4))
def test_first_wins_batches_equal_one_insert_and_replay_adds_nothing(spark, hashes, cuts):
    rows = [(f"h{h}", f"f{i}.jpg", i, 0, i) for i, h in enumerate(hashes)]
    schema = "file_hash string, filename string, kafka_timestamp long, kafka_partition int, kafka_offset long"
    bounds = sorted({c for c in cuts if c < len(rows)} | {0, len(rows)})
    batches = [rows[a:b] for a, b in zip(bounds, bounds[1:])]
    target = spark.createDataFrame([], "id long, file_hash string, filename string")
    for batch in batches:
        added = metadata.insert_first_wins(spark.createDataFrame(batch, schema), target)
        target = spark.createDataFrame(added.select("id", "file_hash", "filename").collect(),
                                       "id long, file_hash string, filename string").unionByName(target)
    once = metadata.insert_first_wins(spark.createDataFrame(rows, schema),
                                      spark.createDataFrame([], "id long, file_hash string"))
    key = lambda df: sorted(tuple(r) for r in df.select("id", "file_hash", "filename").collect())
    assert key(target) == key(once)
    replay = metadata.insert_first_wins(spark.createDataFrame(batches[-1], schema), target)
    assert replay.count() == 0


def test_plain_base64_fast_path_agrees_with_lenient_rules(spark):
    """The one-regex path for plain text gives what the character-map (lenient) path gives."""
    texts = ["", "QQ==", "QUI=", "QUJD", "QUJDRA", "Q===", "QQ=A", "=QQQ", "QUJD\n", "QU JD", "QU\r\nJD",
             "QUJD*", "QUJD==\n", "4pyTIMOgIGxhIG1vZGU=", "4pyT\nIMOg\nIGxh\nIG1v\nZGU=", "ab+/", "ab-_", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    lenient_ok = F.coalesce(binary._lenient_decodable(t), F.lit(False))
    rows = df.select(
        "t", binary.base64_decodable(t).alias("ok"), lenient_ok.alias("ok2"),
        binary.decode_base64(t).alias("d"), F.when(lenient_ok, F.unbase64(binary._cleaned(t))).alias("d2"),
        binary.decoded_length(t).alias("n"), F.octet_length(binary.decode_base64(t)).alias("n2"),
    ).collect()
    for r in rows:
        assert (r["ok"], r["d"], r["n"]) == (r["ok2"], r["d2"], r["n2"]), r["t"]
