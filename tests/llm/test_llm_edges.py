"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

import datetime

import pytest
from pyspark.sql import functions as F

from pilotlamp.llm import chat, decontaminate, katz, merkle, mixing, ngram_join, pii, quality, url_filters, warc

LONG = "long text of many words " * 20_000
KIND = "doc_id long, text string, source string, size string, hits string, member int, spans string, score string, n_active string, own string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, rows that repeat, names that clash with results."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi", "a"), (2, None, "a"), (3, "", None), (None, "words of a row without id here", "b"),
        (4, LONG, "b"), (5, "one", "c"), (5, "one", "c"), (6, "mail me at x@y.example.org or +1 (437) 555-0689", None), (7, "!!! ???", "a"), (None, None, None),
    ]
    return spark.createDataFrame([(*r, "s", "h", 1, "p", "q", "n", "o") for r in rows], KIND)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_decontaminate(spark, odd, none):
    items = bench(spark, [(9, "zeta eta theta"), (10, None), (11, ""), (9, "ONE"), (None, "Mail ME")])
    got = {(r.doc_id, r.n_words): r for r in decontaminate.scan_windows(odd, items).withColumn("hit", decontaminate.contaminated()).collect()}
    assert got[1, 14]["items"] == ["9"] and got[1, 14].hits == [5, 6, 7] and got[1, 14].hit
    assert got[5, 1].hits == [0] and got[6, 12]["items"] == [""] and not got[2, 0].hit and not got[4, 100_000].hit
    small = decontaminate.scan_windows(odd, items, block_words=2)  # one block for each item
    assert sorted(map(str, small.collect())) == sorted(map(str, decontaminate.scan_windows(odd, items).collect()))
    kept = decontaminate.drop_contaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert decontaminate.scan_windows(none, items).count() == 0 and decontaminate.scan_windows(odd, bench(spark, [])).where("size(hits) > 0").count() == 0
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(odd, items).collect() if r.doc_id in (1, 2, 5)}
    assert cut == {1: "alpha beta gamma delta epsilon   iota kappa lambda mu nu xi", 2: None, 5: " "}


def test_mixing(odd, none):
    got = mixing.mix(odd)
    rows = got.collect()
    assert len(rows) == odd.count() and "text" not in got.columns
    total = sum(r["size"] for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - total) < 1e-6 * total
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows) and sorted(map(str, mixing.mix(odd).collect())) == sorted(map(str, rows))
    assert mixing.mix(none).count() == 0


def test_mixing_comes_near_the_targets(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int") + 1).alias("text"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    by = mixing.mix(rows).groupBy("source", "target", "source_size").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 0.03 * r.target + 20 and r.taken <= 3 * r.source_size for r in by)


def test_mixing_gives_the_text_of_every_slot(spark, odd):
    """Slots follow the golden ratio, hold whole blocks in order, and the pieces of an epoch make up each text."""
    from collections import defaultdict

    blanks = [" ", "\n", "\t ", "  "]
    texts = {i: "\n" * (i % 2) + "".join(f"é{i}-{j}{blanks[(i + j) % 4]}" for j in range(1 + i * 37 % 900)) for i in range(60)}
    df = spark.createDataFrame([(i, t, "ab"[i % 3 > 0]) for i, t in texts.items()], "doc_id long, text string, source string")
    filled = mixing.fill_slots(df).cache()
    rows = sorted(mixing.slot_rows(filled).collect(), key=lambda r: (r.slot, r["at"]))
    by = {r.doc_id: r for r in filled.collect()}
    assert len(by) == len(texts) and all(len(r.text.split()) == r.words > 0 for r in rows)
    sources = {r.source: r for r in mixing.plan_sources(df.select("source", mixing.size_of(F.col("text")).alias("size"), F.concat(F.lit("s"), "source").alias("skey"))).withColumn(
        "source", F.substring("skey", 2, 1)).collect()}
    share, slots, rank = sources["a"].slots / (sources["a"].slots + sources["b"].slots), defaultdict(list), {"a": 0, "b": 0}
    for r in rows:
        slots[r.slot].append(r)
    assert list(slots) == list(range(len(slots)))
    runs = {}
    for i, found in slots.items():
        s = "a" if (i * mixing.GOLDEN % 2**32) / 2**32 < share else "b"
        block_no, epoch = rank[s] % sources[s].blocks, rank[s] // sources[s].blocks
        rank[s] += 1
        assert {(r.source, r.epoch) for r in found} == {(s, epoch)}
        assert [r["at"] for r in found] == [sum(x.words for x in found[:k]) for k in range(len(found))]
        assert sum(r.words for r in found) == min(sources[s].block, sources[s].source_size - block_no * sources[s].block)
        assert runs.setdefault((s, block_no), [r.text for r in found]) == [r.text for r in found]
    epochs = defaultdict(list)
    for r in rows:
        epochs[r.doc_id, r.epoch].append(r)
    whole = 0
    for (d, _), found in epochs.items():
        if sum(r.words for r in found) == by[d]["size"]:
            whole += 1
            assert "".join(r.text for r in sorted(found, key=lambda r: r.first_word)) == texts[d]
    assert whole > 40
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    assert taken == {d: sum(r.words for r in rows if r.doc_id == d) for d in texts}
    assert sum(r.taken for r in mixing.fill_slots(odd).collect()) == sum(len(r.text.split()) for r in mixing.slot_rows(mixing.fill_slots(odd)).collect()) > 0


def test_ngram_join(spark, odd, none):
    got = {r.doc_id: r for r in ngram_join.join(odd).collect()}
    assert got[5].n_links == 1 and got[2].n_links == 0 and got[3].class_id == 3 and got[7].n_links == 0
    one = ngram_join.keep_one(odd)
    assert one.columns == odd.columns and one.where("doc_id = 5").count() == 1 and one.count() == odd.count() - 1
    assert ngram_join.join(none).count() == 0 and ngram_join.keep_one(none).count() == 0


def test_ngram_join_tells_texts_apart_whatever_their_ids(spark):
    """Unlike texts with null ids, or with one id, are classes of their own; near copies among them still meet."""
    text = lambda w, change=None: " ".join("x" if i == change else f"{w}{i}" for i in range(80))
    rows = [(None, text("a")), (None, text("b")), (None, text("a", 79)), (7, text("c")), (7, text("d")), (7, text("d", 79)), (8, text("c")), (None, None), (None, "!")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.join(df, keep=["text"]).collect()
    by = {(r.doc_id, r.text): r for r in found}
    key = [by[r].class_key for r in rows]
    assert len(found) == len(rows) and key[7:] == [None, None]
    assert key[0] == key[2] and key[3] == key[6] and key[4] == key[5] and len(set(key[:7])) == 4
    assert [by[r].n_links for r in rows] == [1, 0, 1, 1, 1, 1, 1, 0, 0] and by[rows[3]].copy_key != by[rows[4]].copy_key
    kept = [(r.doc_id, r.text) for r in ngram_join.keep_one(df.unionByName(df.limit(2))).collect()]
    assert len(kept) == 6 and {rows[1], rows[3], rows[7], rows[8]} <= set(kept)
    assert sum(r in (rows[0], rows[2]) for r in kept) == 1 and sum(r in (rows[4], rows[5]) for r in kept) == 1


def test_ngram_join_has_runs_for_one_miss_in_a_thousand():
    assert (1 - ngram_join._survival(ngram_join.DEPTH)) ** ngram_join.runs_for() <= 0.001


def test_ngram_join_splits_large_groups(spark):
    """A group of near copies above all limits is tiled, and every link is counted once."""
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(words[:i % 60] + [f"x{i}"] + words[i % 60 + 1:])) for i in range(60)] + [(100 + i, " ".join(words)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from brute import links

    n, root = links([t for _, t in rows])
    for limits in ({}, {"small": 5, "tile": 16}):
        got = {r.doc_id: r for r in ngram_join.join(df, **limits).collect()}
        assert [got[i].n_links for i, _ in rows] == n
        assert [got[i].class_id for i, _ in rows] == [rows[r][0] for r in root]


def test_ngram_join_splits_a_group_of_near_copies_in_the_first_wave_only(spark, monkeypatch):
    """Other texts that share a passage with the group do not send it down the trees again, and find their own links."""
    passage = [f"w{i}" for i in range(100)]
    group = [(i, " ".join(passage[:i % 90] + [f"x{i}"] + passage[i % 90 + 1:])) for i in range(90)]
    others = [(1000 + i, " ".join(passage[i:i + 40] + [f"y{i // 2}z{j}" for j in range(60)] + [f"e{i}"])) for i in range(12)]
    rows = group + others
    from brute import links

    made, split = [], ngram_join._split

    def counted(members, similarity, runs=None):
        made.append([runs, 0])
        out = split(members, similarity, runs)
        made[-1][1] = out.count()
        return out

    monkeypatch.setattr(ngram_join, "_split", counted)
    found = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), small=30, tile=16)
    n, root = links([t for _, t in rows])
    got = {r.doc_id: r for r in found.collect()}
    assert [got[i].n_links for i, _ in rows] == n and [got[i].class_id for i, _ in rows] == [rows[r][0] for r in root]
    starts = [i for i, (runs, _) in enumerate(made) if runs]
    assert len(starts) == 2 and sum(k for _, k in made[1:starts[1]]) > 0 and sum(k for _, k in made[starts[1] + 1:]) == 0


def test_ngram_join_does_not_split_a_wide_group_of_near_copies(spark, monkeypatch):
    """Few members that all others meet tell the group apart; texts that only share a passage with it go on alone and find their links."""
    passage = [f"w{i}" for i in range(100)]
    group = [(i, " ".join(passage[:i % 90] + [f"x{i}"] + passage[i % 90 + 1:])) for i in range(240)]
    others = [(1000 + i, " ".join(passage[i:i + 40] + [f"y{i // 2}z{j}" for j in range(60)] + [f"e{i}"])) for i in range(50)]
    rows = group + others
    from brute import links

    made, split = [], ngram_join._split

    def counted(members, similarity, runs=None):
        out = split(members, similarity, runs)
        if not runs:
            made.append(out.select("member").distinct().count())
        return out

    monkeypatch.setattr(ngram_join, "_split", counted)
    found = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), small=30, tile=64)
    n, root = links([t for _, t in rows])
    got = {r.doc_id: r for r in found.collect()}
    assert [got[i].n_links for i, _ in rows] == n and [got[i].class_id for i, _ in rows] == [rows[r][0] for r in root]
    assert max(made, default=0) <= len(others)  # at every level, the others at most


def test_pii(odd, none):
    got = pii.find(odd)
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in got.collect() if r.doc_id}
    assert spans[6] == [("email", 11, 26), ("phone", 30, 47)] and spans[2] == [] and spans[4] == []
    text = {r.doc_id: r.text for r in pii.redact(odd).collect() if r.doc_id in (2, 6)}
    assert text == {2: None, 6: "mail me at <EMAIL> or <PHONE>"}
    assert pii.redact(odd).columns == [c for c in odd.columns if c != "spans"] and pii.find(none).count() == 0


def test_pii_searches_go_on_where_a_match_ended(spark):
    from brute import personal

    cases = ["a@b.com_x@y.com", "..a@b..c@d.e", "1.2.3.4.5.6.7.8.9", "1.2.3.400 5.6.7.8", "4111 1111 1111 1111-4111111111111111", "+1+2 (3)4 5678901-2", "x" * 3000 + "@a.b", "é@ü.de ñ a@é.de 💥a@b.cc 1.1.1.1"]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.base] for r in pii.find(df).collect()}
    assert [got[i] for i in range(len(cases))] == [personal(t) for t in cases]


def test_pii_proposes_secrets_whose_digit_or_letter_comes_late(spark):
    secrets = ["token: " + "aB_-" * 15 + "7", "token: " + "12_-" * 15 + "k", "token: abcdefghij0123456789"]
    others = ["a-" * 30, "1_" * 30, "-" * 80, "token: abc1"]
    df = spark.createDataFrame(list(enumerate(secrets + others)), "doc_id long, text string")
    found = F.filter(pii._found("secret", F.col("text")), lambda m: pii._passes("secret", m["hit"]))
    got = {r.doc_id: [(m.start, m.end) for m in r.found] for r in df.select("doc_id", found.alias("found")).collect()}
    assert got == {i: [(7, len(t))] if i < 3 else [] for i, t in enumerate(secrets + others)}


def test_em_tells_good_labelers_from_bad():
    counts = {("secret", "++++"): 50, ("secret", "+0++"): 30, ("secret", "-0--"): 60, ("secret", "-+0-"): 20}
    posterior, rel = pii.fit_votes(counts)
    assert posterior["secret", "++++"] > 0.9 and posterior["secret", "-0--"] < 0.1 and 0.3 < rel["prior"]["secret"] < 0.7


def test_quality(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 1), (5, 0), (6, None), (None, 1)], "doc_id long, quality int")
    got = quality.score_quality(odd, labels)
    rows = got.collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows) and all(r.held_out for r in rows if r.doc_id is None)
    assert quality.score_quality(none, labels).count() == 0
    assert {r.score for r in quality.score_quality(odd, labels.where("false")).collect()} == {0.5}
    assert quality.keep_good(odd, labels.where("false")).count() == odd.count()


def test_warc(spark):
    body = "<p>" + "same body " * 200
    rows = [(1, "http://a/", body), (2, "http://b/", body), (7, None, body), (3, "http://c/\r\nx", "small"), (4, "u", "small"), (5, "u", None), (None, "n", body), (6, "l", LONG * 4), (7, None, body)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest, folder = warc.write_archives(pages)
    got = warc.read_archives(manifest, folder).collect()
    assert len(got) == len(rows)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert kinds == {1: ("revisit", 7), 2: ("revisit", 7), 7: ("response", None), 3: ("response", None), 4: ("response", None), 5: ("response", None), None: ("revisit", 7), 6: ("response", None)}
    payload = {r.page_id: r.payload for r in got}
    assert bytes(payload[6]) == (LONG * 4).encode() and bytes(payload[5]) == b"" and payload[1] is None
    assert warc.read_archives(*warc.write_archives(pages.where("false"))).count() == 0


def test_warc_archive_is_plain_zstandard(tmp_path):
    import io

    import zstandard

    records = [warc.record(i, f"http://h/{i}", f"<p>page {i}".encode() * 50, "00" * 20, None, False) for i in range(300)]
    out = io.BytesIO()
    warc.write_archive(out, records)
    data = out.getvalue()
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
    size = int.from_bytes(data[4:8], "little")
    words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + size]))
    assert zstandard.ZstdDecompressor(dict_data=words).stream_reader(io.BytesIO(data[8 + size:]), read_across_frames=True).read() == b"".join(records)
    assert list(warc.read_archive(io.BytesIO(data))) == records


TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def test_chat(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "\n\n  <\\|x <|", None, "", "💥é ñ\r\n", "a" * 5000, "end "]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)] + [(None, 0, None, "x"), (2, None, "assistant", "same"), (2, None, "assistant", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    import hashlib

    for size in (10, 10_000):
        blocks = chat.format_conversations(df, TOKENIZER, block_chars=size)
        got = {r.conv_id: r for r in chat.digest(blocks).collect()}
        learnt = "".join(t or "" for i, t in enumerate(texts) if i % 2)
        turns = "".join(f"{'assistant' if i % 2 else 'user'}\n{t or ''}\n" for i, t in enumerate(texts))
        assert got[1].n_turns == len(texts) and got[1].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
        assert got[1].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest() and got[1].loss_chars == len(learnt)
        assert got[2].n_turns == 2 and got[2].loss_chars == 8 and got[None].loss_chars == 0
    whole = chat.load_tokenizer(open(TOKENIZER, encoding="utf-8").read())
    parts = chat.format_conversations(df.where("conv_id = 1"), TOKENIZER, block_chars=10).orderBy("block").collect()
    text = "".join(p.text for p in parts)
    assert [i for p in parts for i in p.input_ids] == whole.encode(text, add_special_tokens=False).ids  # blocks change no token
    assert whole.decode([i for p in parts for i in p.input_ids], skip_special_tokens=False) == text
    assert chat.digest(chat.format_conversations(df.where("false"), TOKENIZER)).count() == 0


def test_escape_is_reversible():
    for t in ("<|", "<\\|", "<\\\\|a|>", "<<||", "plain", "\\<|\\"):
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)


def test_merkle(odd, none):
    got = merkle.fingerprint_edits(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    same = [r.fingerprint for r in got if r.doc_id == 5]
    assert len(same) == 2 and len(set(same)) == 1 and sorted(r.near_next for r in got if r.doc_id == 5)[1] == 1
    assert merkle.fingerprint_edits(none).count() == 0


def test_merkle_ranges_change_nothing(spark, monkeypatch):
    df = spark.range(500).select((F.col("id") * 7 % 501).alias("doc_id"), F.concat(F.lit("line\n"), F.repeat(F.col("id").cast("string"), 20)).alias("text"))
    want = sorted(map(str, merkle.fingerprint_edits(df).collect()))
    monkeypatch.setattr(merkle, "BUCKET_ROWS", 20)
    assert sorted(map(str, merkle.fingerprint_edits(df).collect())) == want


def test_merkle_locates_edits(spark):
    lines = [f"paragraph number {i} of the text" for i in range(40)]
    df = spark.createDataFrame([(1, "\n".join(lines), "\n".join([*lines[:20], "another", *lines[21:]]))], "doc_id long, a string, b string")
    row = merkle.with_tree(merkle.with_tree(df, F.col("a"), "a"), F.col("b"), "b").select(merkle.edited_paragraphs("a", "b").alias("new"), F.md5(F.lit("x")), "b_paragraphs", merkle.likeness("a", "b").alias("near")).first()
    assert row.new == [row.b_paragraphs[20]] and 0.9 < row.near < 1


def test_url_filters(spark, odd, none):
    day = lambda d: datetime.date(2024, 1, d)
    entries = spark.createDataFrame([
        ("domain", "bad.org", "ads", "add", day(5)), ("domain", "bad.org", "ads", "remove", day(10)), ("domain", "bad.org", "ads", "add", day(20)),
        ("host", "one.bad.org", "spam", "add", day(1)), ("host", "one.bad.org", "spam", "remove", day(1)), ("prefix", "www.bad.org/ok/deep", "allow", "add", day(6)),
        (None, "x", "ads", "add", day(1)), ("host", "x.y", None, "add", day(1)),
    ], "kind string, pattern string, category string, action string, dated date")
    cases = [
        ("http://www.bad.org/", 4, False), ("http://www.bad.org/", 5, True), ("https://u@WWW.BAD.org:80/x?q#f", 9, True), ("http://bad.org", 10, False), ("http://bad.org", 25, True),
        ("http://notbad.org/", 25, False), ("http://one.bad.org/", 2, False), ("http://www.bad.org/ok//deep/er", 7, False), ("http://www.bad.org/ok/deeper", 7, True), (None, 7, False), ("junk", 7, False), ("http://bad.org", None, False),
    ]
    df = spark.createDataFrame([(i, u, day(d) if d else None, "z") for i, (u, d, _) in enumerate(cases)], "page_id long, url string, fetched date, blocked string")
    got = {r.page_id: r.blocked for r in url_filters.judge(df.unionByName(df), entries).collect()}
    assert got == {i: c[2] for i, c in enumerate(cases)}
    assert url_filters.judge(df.where("false"), entries).count() == 0 and url_filters.judge(df, entries.where("false")).where("blocked").count() == 0


def test_url_filters_judge_by_the_hour(spark):
    at = lambda d, h: datetime.datetime(2024, 1, d, h)
    entries = spark.createDataFrame([
        ("host", "a.org", "ads", "add", at(5, 9)), ("host", "a.org", "ads", "remove", at(5, 17)), ("host", "b.org", "spam", "add", at(5, 9)),
    ], "kind string, pattern string, category string, action string, dated timestamp")
    cases = [("a", at(5, 8), 0), ("a", at(5, 9), 1), ("a", at(5, 16), 1), ("a", at(5, 17), 0), ("b", at(5, 8), 0), ("b", at(5, 10), 1), ("b", at(28, 0), 1)]
    df = spark.createDataFrame([(i, f"http://{h}.org/", t) for i, (h, t, _) in enumerate(cases)], "page_id long, url string, fetched timestamp")
    got = {r.page_id: r.n_active for r in url_filters.judge(df, entries).collect()}
    assert got == {i: c[2] for i, c in enumerate(cases)}


def test_katz(odd, none):
    got = katz.score(odd).collect()
    assert len(got) == odd.count() and all(r.held_out for r in got if r.doc_id is None)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3)} == {1} and katz.score(none).count() == 0
    only = katz.score(odd.where("doc_id IS NULL")).collect()
    assert all(r.train_tokens == 0 and abs(r.score) < 1e-9 and r.n_known == 0 for r in only)


def test_katz_frequent_words_change_nothing(spark, monkeypatch):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("the of the"), F.col("id") % 7, F.lit("the"), F.col("id") % 13).alias("text"))
    want = {r.doc_id: (round(r.score, 9), round(r.base_score, 9), r.n_known) for r in katz.score(df).collect()}
    monkeypatch.setattr(katz, "SAMPLE", 1.0)
    monkeypatch.setattr(katz, "PART_CHARS", 200)
    assert {r.doc_id: (round(r.score, 9), round(r.base_score, 9), r.n_known) for r in katz.score(df).collect()} == want
