from __future__ import annotations

import base64
import json

from conftest import rows

from cartwheel.streaming import orders as stream

RECORD = {"order_id": 1, "user_id": 2, "order_number": 3, "order_dow": 4, "order_hour_of_day": 5, "days_since_prior": 6}


def encoded(text):
    return base64.b64encode(text.encode()).decode()


def expected_line(**changes):
    r = {**RECORD, **changes}
    ordered = {k: r.get(k) for k in ("order_id", "user_id")}
    ordered["eval_set"] = "dummy streaming"
    ordered.update({k: r.get(k) for k in ("order_number", "order_dow", "order_hour_of_day", "days_since_prior")})
    return json.dumps(ordered) + "\n"


CASES = {
    "ok": (encoded(json.dumps(RECORD)), expected_line()),
    "null": (encoded(json.dumps({**RECORD, "days_since_prior": None})), expected_line(days_since_prior=0)),
    "absent": (encoded(json.dumps({"order_id": 9})), None),
    "high": (encoded(json.dumps({**RECORD, "days_since_prior": 31})), expected_line(days_since_prior=30)),
    "negative": (encoded(json.dumps({**RECORD, "days_since_prior": -3})), expected_line(days_since_prior=-3)),
    "broken": (encoded('{"order_id": 1, '), None),
    "array": (encoded("[1]"), None),
    "number": (encoded("5"), None),
    "empty": (encoded(""), None),
    "no-base64": ("***", None),
    "null-data": (None, None),
    "bad-utf8": (base64.b64encode(b'{"order_id": 1, "x": "\xff\xfe"}').decode(), None),
    "float-gap": (encoded(json.dumps({**RECORD, "days_since_prior": 7.5})), expected_line(days_since_prior=7.5)),
    "text-id": (encoded(json.dumps({**RECORD, "order_id": "12"})), expected_line(order_id="12")),
    "text-gap": (encoded(json.dumps({**RECORD, "days_since_prior": "7"})), None),
    "list-number": (encoded(json.dumps({**RECORD, "order_number": [1, 2]})), None),
}


def envelopes(spark):
    return spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "recordId string, data string")


def test_transform(spark):
    out = {r["recordId"]: r for r in stream.transform_order_stream(envelopes(spark)).collect()}
    for name, (data, line) in CASES.items():
        if name == "list-number":
            assert out[name]["result"] == stream.OK and out[name]["order_number"] is None
        elif name == "absent":
            assert base64.b64decode(out[name]["data"]).decode() == (
                '{"order_id": 9, "user_id": null, "eval_set": "dummy streaming", "order_number": null, '
                '"order_dow": null, "order_hour_of_day": null, "days_since_prior": 0}\n'
            )
        elif line is None:
            assert (out[name]["result"], out[name]["data"]) == (stream.FAILED, data), name
        else:
            assert out[name]["result"] == stream.OK, name
            assert base64.b64decode(out[name]["data"]).decode() == line, name
    assert out["no-base64"]["error_type"] == out["bad-utf8"]["error_type"] == stream.DECODE_ERROR
    assert out["text-id"]["order_id"] == 12 and out["text-gap"]["error_type"] == stream.PARSE_ERROR
    assert out["broken"]["error_type"] == stream.PARSE_ERROR


def run_all(spark, root):
    source = stream.read_order_stream(spark, f"{root}/in", files_per_trigger=1)
    done = stream.transform_order_stream(source)
    stream.stream_sink(done, f"{root}/out", f"{root}/errors", f"{root}/state").awaitTermination()


def run(spark, root):
    run_all(spark, root)
    return spark.read.parquet(f"{root}/out"), spark.read.json(f"{root}/errors")


def test_stream_equals_batch_and_a_second_run_adds_only_new_files(spark, tmp_path):
    df = envelopes(spark)
    df.coalesce(1).write.json(f"{tmp_path}/in")
    good, failed = stream.split_failures(stream.transform_order_stream(df))
    out, errors = run(spark, tmp_path)
    assert rows(out.select(good.columns), "recordId") == rows(good, "recordId")
    assert rows(errors.select("recordId", "error_type"), "recordId") == rows(failed.select("recordId", "error_type"), "recordId")
    df.filter("recordId = 'ok'").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    out, errors = run(spark, tmp_path)
    assert out.filter("recordId = 'ok'").count() == 2
    assert errors.count() == failed.count()


def test_stream_goes_on_after_a_bad_record(spark, tmp_path):
    df = envelopes(spark)
    df.filter("recordId = 'bad-utf8'").coalesce(1).write.json(f"{tmp_path}/in")
    run_all(spark, tmp_path)
    df.filter("recordId = 'ok'").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    out, errors = run(spark, tmp_path)
    assert (out.count(), errors.count()) == (1, 1)
