"""Archives: what is written is read back, and repeated payloads are revisits of the least row."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from dupelens.llm import warc

TRAP = "<p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n</p>"


def sample():
    out = [(5, "http://a/é x", "<p>one</p>"), (3, "http://b", "<p>one</p>"), (3, None, "<p>one</p>"), (9, "http://c\r\nX-Row-Id: 7", "two")]
    out += [(1, "http://t", TRAP), (2, "http://t", TRAP), (6, None, None), (4, "http://e", ""), (None, "http://n", "null id"), (None, None, "null id")]
    out += [(None, "http://n", "<p>one</p>"), (7, "http://s", "same"), (7, "http://s", "same"), (7, "http://s", "same"), (8, "http://u", "ünï ☃" * 9000)]
    return out + [(100 + i, f"http://x/{i}", f"page {i % 25} " * (i % 7 + 1)) for i in range(60)]


def pages(spark, rows=None):
    frame = spark.createDataFrame(sample() if rows is None else rows, "page_id long, url string, html string")
    for name in ("id", "uri", "payload", "digest", "bytes", "n", "first", "type", "word", "bits"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame.repartition(5)


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, least=0):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
    first, out = {}, []
    for key, _, html in order:
        payload = (html or "").encode()
        revisit = len(payload) >= least and payload in first
        out.append((key, len(payload), digest(payload), "revisit" if revisit else "response", first[payload] if revisit else None))
        first.setdefault(payload, key)
    return sorted(out, key=repr)


@pytest.mark.parametrize("rule", [warc.Rule(), warc.Rule(least_bytes=9), warc.Rule(archive_bytes=300)])
def test_archives_give_back_every_page(spark, rule):
    found = warc.archived(pages(spark), rule)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected(sample(), rule.least_bytes)


def test_files_hold_whole_records_and_each_payload_once(spark, tmp_path):
    path = str(tmp_path / "archives")
    warc.write(pages(spark), path, warc.Rule(archive_bytes=2_000))
    files = [f for f in (tmp_path / "archives").iterdir() if f.name.startswith("part-") and f.stat().st_size]
    held, names, refers, kinds = [], [], [], set()
    for file in files:
        records = list(warc.parsed(file.read_bytes()))
        assert records[0][0]["warc-type"] == "warcinfo"
        kinds.update(fields["warc-type"] for fields, _ in records)
        for fields, block in records[1:]:
            names.append(fields["warc-record-id"])
            assert int(fields["content-length"]) == len(block)
            assert fields["warc-block-digest"] == "sha1:" + digest(block)
            if fields["warc-type"] == "response":
                held.append(block.split(b"\r\n\r\n", 1)[1])
            else:
                refers.append((fields["warc-refers-to"], fields["warc-payload-digest"]))
        bodies = [len(b) for f, b in records[1:]]
        assert len(bodies) == 1 or sum(bodies) <= 2_000
    assert len(files) > 5 and kinds == {"warcinfo", "response", "revisit"}
    assert sorted(held) == sorted({(h or "").encode() for _, _, h in sample()})
    assert len(set(names)) == len(names) == len(sample())
    assert {r for r, _ in refers} <= set(names)

    back = warc.read(spark, path, payloads=True)
    assert back.where("type = 'response' and not intact").count() == 0
    assert {r.uri for r in back.where("id in (5, 9)").collect()} == {"http://a/%C3%A9%20x", "http://c%0D%0AX-Row-Id:%207"}
    assert {bytes(r.payload) for r in back.where("type = 'response'").collect()} == set(held)


def test_several_archives_resolve_by_digest(spark):
    rows = [(1, "u", "response", "<a>", None, 3, "D", True), (2, "u", "response", "<b>", None, 3, "D", True)]
    rows += [(3, "u", "revisit", "<c>", "<b>", None, "D", True), (4, "u", "revisit", "<d>", "<z>", None, "Z", True)]
    found = {r.id: (r.bytes, r.refers_to) for r in warc.resolved(spark.createDataFrame(rows, warc.HEADERS)).collect()}
    assert found == {1: (3, None), 2: (3, None), 3: (3, 1), 4: (None, None)}


def test_empty_table_and_broken_archives(spark):
    assert warc.archived(pages(spark, [])).count() == 0
    whole = warc.record([("WARC-Type", "response")], b"abc") + warc.END
    assert [b for _, b in warc.parsed(whole * 2)] == [b"abc"] * 2
    for broken in (whole[:-6], b"x" + whole, whole[:-1]):
        with pytest.raises(ValueError):
            list(warc.parsed(broken))


def test_bitmap_marks_all_repeated_digests_and_few_others(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("digest"), F.lit(1).cast("long").alias("bytes"))
    marked = warc._marked(rows, rows.where("cast(digest as long) % 10 = 0"), warc.Rule())
    counts = marked.groupBy((F.col("digest").cast("long") % 10 == 0).alias("repeated")).agg(F.count_if("shared").alias("n")).collect()
    found = {r.repeated: r.n for r in counts}
    assert found[True] == 300 and found[False] < 300


def test_unique_payloads_are_not_shuffled(spark):
    rows = pages(spark)
    found = warc.captures(rows)
    plan = warc._marked(found, found.select("digest").limit(3), warc.Rule()).where("not shared")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
