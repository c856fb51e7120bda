import json

from quillspan.operators.cutting import trajectory_entries
from quillspan.operators.judge import judge
from quillspan.schema import JUDGED, ROLLOUT
from quillspan.sources import chat, pool, records
from quillspan.streaming import judged as streaming
from tests.test_operators import CHECK, EDIT, rollout
from tests.transcript import TURNS, turns as transcript


def test_pool_reads_shards_with_differing_columns(spark, tmp_path):
    one = spark.createDataFrame([("a__b.1.func", transcript(), "py")], f"instance_id string, messages {TURNS}, language string")
    speakers = "array<struct<speaker:string,text:string>>"
    two = spark.createDataFrame([("c-1", transcript(), 7)], f"instance_id string, messages {speakers}, other int")
    for source, df in (("mini-coder", one), ("swe-hero", two)):
        target = tmp_path / source / "data"
        df.coalesce(1).write.parquet(str(tmp_path / "raw" / source))
        target.mkdir(parents=True)
        part = next((tmp_path / "raw" / source).glob("*.parquet"))
        part.rename(target / "train-00000.parquet")
    a = pool.read_source(spark, str(tmp_path), "mini-coder")
    assert a.select("shard", "row_in_shard").first() == ("mini-coder/data/train-00000.parquet", 0)
    b = trajectory_entries(pool.read_source(spark, str(tmp_path), "swe-hero")).first()
    assert (b.first_edit, b.asst, b.language) == (4, 7, "python")
    whole = pool.read_pool(spark, str(tmp_path), ("mini-coder", "open-swe-traces"))
    assert whole.count() == 1 and "first_edit" in whole.columns
    assert pool.read_pool(spark, str(tmp_path), ("open-swe-traces",)).count() == 0


def test_jsonl_keeps_nulls_and_unusual_line_ends(spark, tmp_path):
    df = spark.createDataFrame([("a b\x85c", None)], "k string, v string")
    records.write_jsonl(df, str(tmp_path / "out"))
    written = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("*.json"))
    assert json.loads(written) == {"k": "a b\x85c", "v": None}
    (tmp_path / "in.jsonl").write_text("\n" + written + "\n\n", encoding="utf-8")
    assert records.read_jsonl(spark, str(tmp_path / "in.jsonl"), df.schema).collect() == df.collect()


def test_split_round_trip(spark, tmp_path):
    rows = judge(rollout(spark, [CHECK, EDIT, CHECK]).union(rollout(spark, ["ls"])))
    rows = rows.select(*JUDGED.fieldNames())
    records.write_split(rows, str(tmp_path / "judged"))
    back = records.read_split(spark, str(tmp_path / "judged"), JUDGED)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    assert records.read_split(spark, str(tmp_path / "judged"), JUDGED, keep=True).count() == 1


def test_report_and_recipe(tmp_path):
    records.write_report(records.recipe("base", "sft", "dpo", "out"), str(tmp_path / "x" / "recipe.json"))
    assert json.loads((tmp_path / "x" / "recipe.json").read_text())["order"] == ["sft", "dpo"]


def _answers(url, body, timeout):
    assert url == "http://h/v1/chat/completions" and json.loads(body)["max_tokens"] == 1024 and timeout == 120
    return json.dumps({"choices": [{"message": {"content": "said"}}]}).encode()


def test_chat_policy():
    policy = chat.ChatPolicy("http://h/v1/", "m", post=_answers)
    assert policy([{"role": "user", "content": "x"}], 0) == "said"


def test_stream_judges_files_once(spark, tmp_path):
    rows = rollout(spark, [CHECK, EDIT, CHECK]).union(rollout(spark, ["ls"]))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = streaming.judged_stream(spark, str(tmp_path / "in"))
        streaming.write_judged(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 2 and out.where("drop = 'true'").count() == 1
    assert set(ROLLOUT.fieldNames()) <= set(out.columns)
