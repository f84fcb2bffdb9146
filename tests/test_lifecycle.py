import random
import uuid

from quillspark.streaming import lifecycle

CAP = 100


def expected(rows, watermark):
    out, open_ = [], {}
    for s, ts, _, ends in sorted(rows, key=lambda r: (r[1], r[2])):
        n, start, k = open_.get(s, (0, 0, 0))
        if k and ts >= start + CAP:
            out.append((s, n, start, start + CAP, k, "expired"))
            k = 0
        if not k:
            n, start = n + 1, ts
        k += 1
        if ends:
            out.append((s, n, start, ts, k, ends))
            k = 0
        open_[s] = (n, start, k)
    out += [(s, n, start, start + CAP, k, "expired") for s, (n, start, k) in open_.items() if k and start + CAP <= watermark]
    return sorted(out)


def test_one_batch_and_three(spark, tmp_path):
    r = random.Random(3)
    rows = [(f"s{r.randint(0, 6)}", i * 7, i, r.choice(["", "", "", "", "done", "blocked", "failed", None])) for i in range(240)] + [("late", 240 * 7, 999, "")]
    rows.insert(0, ("alone", 3, 1000, ""))
    schema = "session string, t long, id long, ends string"
    df = lambda x: spark.createDataFrame(x, schema).selectExpr("session", "timestamp_seconds(t + 1000000) ts", "id", "ends")
    want = [(s, n, (a + 1_000_000) * 1_000_000, (b + 1_000_000) * 1_000_000, k, e) for s, n, a, b, k, e in expected(rows, 240 * 7)]
    for cuts in ([0, 242], [0, 80, 170, 242]):
        at = str(tmp_path / uuid.uuid4().hex)
        for a, b in zip(cuts, cuts[1:], strict=False):
            df(rows[a:b]).coalesce(1).write.mode("append").parquet(at)
            stream = lifecycle.lifecycles(spark.readStream.schema(df(rows[:1]).schema).parquet(at), CAP)
            got = lifecycle.replay(spark, stream, f"life-{len(cuts)}-{at[-8:]}")
        assert sorted(map(tuple, got.collect())) == want
    assert any(x[0] == "alone" for x in want) and not any(x[0] == "late" for x in want)
