"""Timelines kept by a stream against the batch job, after every delivery; what a celebrity's post costs."""

import json
import os
import random
import time
from types import SimpleNamespace

from pyspark.sql import Row
from pyspark.sql import functions as F

from larkspur.operators.social import timeline_posts
from larkspur.plans.tables import in_slices
from larkspur.streaming.timelines import AuthorProcessor, ReaderProcessor, fan_out, timelines_at, timelines_query

POSTS = "uid long, pid long, timestamp string, content string"
FOLLOWS = "src long, dst long"


def write(folder, number, schema, rows):
    folder.mkdir(exist_ok=True)
    names = [part.split()[0] for part in schema.split(", ")]
    (folder / f"{number}.json").write_text("".join(json.dumps(dict(zip(names, r))) + "\n" for r in rows))
    at = time.time() - 9_000 + number
    os.utime(folder / f"{number}.json", (at, at))


def streams(spark, tmp_path):
    def stream(name, schema):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).json(str(tmp_path / name))

    return stream("posts", POSTS), stream("follows", FOLLOWS)


def table(frame):
    return sorted(map(tuple, frame.collect()))


def test_any_sequence_equals_the_batch_job(spark, tmp_path):
    rng = random.Random(6)
    posts, follows = [], set()
    for step in range(3):
        new_posts = [
            (rng.choice([1, 1, 2, 3, 4]), 100 * step + n, rng.choice(["soon", f"2020-01-0{rng.randint(1, 9)} 00:00:0{n % 3}"]), f"p{n}")
            for n in range(24)
        ]
        new_follows = {(rng.randint(10, 24), rng.choice([1, 1, 2, 3, 4, 5])) for _ in range(12)}
        posts, follows = posts + new_posts, follows | new_follows
        write(tmp_path / "posts", 2 * step, POSTS, new_posts[:15] + new_posts[:2] + [(None, 5, None, None)])
        write(tmp_path / "posts", 2 * step + 1, POSTS, new_posts[15:])
        write(tmp_path / "follows", step, FOLLOWS, sorted(new_follows) + [(None, 1)])
        query, checkpoint = timelines_query(*streams(spark, tmp_path), str(tmp_path / "cp"), k=5, celebrity=6)
        query.awaitTermination()
        want = timeline_posts(spark.createDataFrame(sorted(follows), FOLLOWS), spark.createDataFrame(posts, POSTS), k=5)
        assert table(timelines_at(spark, checkpoint, k=5)) == table(want)
    some = spark.createDataFrame([(10,), (11,), (99,)], "user_id long")
    assert table(timelines_at(spark, checkpoint, some, 5)) == [r for r in table(want) if r[0] in (10, 11)]


def test_a_celebrity_post_writes_no_row_for_its_followers(spark, tmp_path):
    write(tmp_path / "follows", 0, FOLLOWS, [(u, 1) for u in range(100, 400)] + [(u, 2) for u in range(100, 110)])
    write(tmp_path / "posts", 0, POSTS, [(1, 1, "2020-01-01 00:00:00", "a")])
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")

    def serve():
        sent = fan_out(*streams(spark, tmp_path), k=5, celebrity=50)
        sent.writeStream.format("parquet").option("checkpointLocation", cp).trigger(availableNow=True).start(out).awaitTermination()
        return spark.read.parquet(out)

    assert serve().where("uid = 1 AND pid IS NULL").count() == 300
    write(tmp_path / "posts", 1, POSTS, [(1, 2, "2020-01-02 00:00:00", "b"), (2, 3, "2020-01-02 00:00:00", "c")])
    sent = serve()
    assert sent.where("uid = 1 AND pid IS NOT NULL").count() == 0
    assert sent.where("pid = 3").count() == 10


class Value:
    """A state variable of one value that counts the calls to it."""

    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


def test_a_delivery_costs_few_calls_to_the_state():
    made = []
    handle = SimpleNamespace(getValueState=lambda name, schema: made.append(Value()) or made[-1])
    author, reader = AuthorProcessor(k=5), ReaderProcessor(k=5)
    author.init(handle), reader.init(handle)
    row = Row("user_id", "uid", "pid", "at", "timestamp", "content")
    rows = [row(u, 1, None, None, None, None) for u in range(500)] + [row(None, 1, p, p, "t", "c") for p in range(40)]
    sent = list(author.handleInputRows((1,), iter(rows), None))
    assert sorted((s.user_id, s.pid) for s in sent) == [(u, p) for u in range(500) for p in range(35, 40)]
    rows = [row(7, a, p, p, "t", "c") for a in range(9) for p in range(400)]
    assert list(reader.handleInputRows((7,), iter(rows), None)) == []
    assert [p[:2] for p in made[2].value[0]] == [(a, 399) for a in range(5)]
    assert sum(v.calls for v in made) <= 8


def test_slices_have_few_files(spark, tmp_path):
    rows = spark.range(600).repartition(6)
    in_slices(rows, str(tmp_path / "s"), F.col("id"), 3, files=2)
    assert len(list((tmp_path / "s").glob("*.parquet"))) <= 6
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "s")).collect()) == list(range(600))
