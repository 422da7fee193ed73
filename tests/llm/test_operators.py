"""Training-data operators against brute force, the tokenizers library, round trips and SQL, with the odd rows."""

import gzip
import hashlib
import io
import itertools
import json
import random
import re
import zipfile
import zlib
from fractions import Fraction
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import _bpe, bpe, chat_format, decontaminate, jaccard_join, order_minhash, queries, token_counts, token_files, toxicity, url_rules, warc_zip

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "plain words here", "  two  spaces \n\n\tand tabs ", "naïve ¿qué? 漢字 ½² 🙂", "x<|endoftext|>y", "it's we'll 'tis", "word " * 3000, "a" * 400, None]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash with the operators' own."""
    rows = [(k, t, "en", "x", 1) for k, t in enumerate(ODD)] + [(1, ODD[1], "en", "x", 1), (None, "no id", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, word string, ids int")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, SF).toArrow(), duck.sql(queries.SQL[name]).to_arrow_table()
    names = sorted(got.column_names)
    assert names == sorted(want.column_names) and got.num_rows
    assert ordered(zip(*(got.column(c).to_pylist() for c in names))) == ordered(zip(*(want.column(c).to_pylist() for c in names)))


def test_speculation_and_merging_equal_the_library(library):
    v, guess = _bpe.Vocabulary(PATH), _bpe.speculation(PATH)
    points = [chr(c) for c in range(0x3400) if not 0xD800 <= c <= 0xDFFF]
    texts = [t or "" for t in ODD] + ["".join(points[k : k + 800]) for k in range(0, len(points), 800)] + [" a".join(points[k : k + 800]) for k in range(0, len(points), 800)]
    flat, begins = v.encode(texts, guess)
    assert [flat[a:b].tolist() for a, b in zip(begins, begins[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_codec_round_trip(odd, library, rows):
    found = rows(bpe.decode(bpe.encode(odd, PATH), PATH), "doc_id")
    assert len(found) == len(ODD) + 2 and found == rows(bpe.round_trip(odd, PATH), "doc_id")
    for r in found:
        assert r["ids"] == library.encode(r["text"], add_special_tokens=False).ids
    assert {r["text"] for r in found} == {t or "" for t in ODD} | {"no id"}


def test_counts_equal_the_library(odd, library, rows):
    found = rows(token_counts.token_counts(odd, PATH), "doc_id")
    texts = {k: t or "" for k, t in enumerate(ODD)} | {None: "no id"}
    assert len(found) == len(ODD) + 2
    for r in found:
        assert (r["n_tokens"], r["n_bytes"]) == (len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids), len(texts[r["doc_id"]].encode()))


def test_token_files(odd, library, rows):
    folder, files = token_files.write_tokens(odd, PATH)
    read = rows(token_files.read_tokens(folder, files), "start")
    assert [r["doc_id"] for r in read] == [None, 0, 1, 1, *range(2, len(ODD))]
    assert all(a["start"] + len(a["ids"]) == b["start"] for a, b in zip(read, read[1:]))
    assert all(r["ids"][-1] == 0 for r in read)
    sums = {r["start"]: r["ids_crc32"] for r in token_files.checksums(folder, files).collect()}
    assert all(sums[r["start"]] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in read)


def test_any_token_of_a_file():
    ids = np.array([0, 255, 256, 65535, 65536, 2**32 - 1, 7] * 400, np.uint32)
    file = token_files.TokenFile(io.BytesIO(token_files.pack(ids, np.array([0, 5, len(ids)]), pa.array(["a", None]))))
    assert file.names().to_pylist() == ["a", None] and file.starts().tolist() == [0, 5, len(ids)]
    assert [file.token(k) for k in range(0, len(ids), 13)] == ids[::13].tolist()
    assert (file.span(511, 1025) == ids[511:1025]).all()


def test_fingerprints(odd, rows):
    known = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    found = rows(order_minhash.spliced(known), "doc_id")
    texts = [t or "" for t in ODD]
    for r in found:
        t, n = texts[r["doc_id"]], texts[(r["doc_id"] - 1) % len(texts)]
        assert r["edited"] == t[: len(t) - len(t) // 2] + n[: len(t) // 2]
    assert order_minhash.spliced(odd).where("doc_id is null").count() == 1
    made = rows(odd.select("doc_id", order_minhash.sketch(F.col("text")).alias("s"), order_minhash.fingerprint(order_minhash.sketch(F.col("text"))).alias("f")))
    assert len({r["f"] for r in made if r["doc_id"] == 1}) == 1 and all(len(r["s"]) == order_minhash.SKETCHES for r in made)
    words = [f"w{k}" for k in range(400)]
    turned = odd.sparkSession.createDataFrame([(" ".join(words), " ".join(words[:390] + ["x"] * 10), " ".join(words[::-1]))], "a string, b string, c string")
    s = {c: order_minhash.sketch(F.col(c)) for c in "abc"}
    near, far = turned.select(order_minhash.likeness(s["a"], s["b"]), order_minhash.likeness(s["a"], s["c"])).first()
    assert near > 0.8 and far < 0.1


def jaccard_groups(texts, size, share):
    sets = {}
    for k, t in texts.items():
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
        sets[k] = {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()
    top = {k: k for k in texts}
    links = [(a, b) for a, b in itertools.combinations(sorted(texts), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]) - 1e-9]
    for _ in texts:
        for a, b in links:
            top[a] = top[b] = min(top[a], top[b])
    return {k: (len(sets[k]), top[k]) for k in texts}


@pytest.mark.parametrize(("size", "threshold"), [(5, "0.8"), (3, "0.9")])
def test_jaccard_groups_equal_brute_force(spark, size, threshold):
    rng = np.random.default_rng(5)
    base = [f"t{k}" for k in rng.integers(0, 60, 80)]
    texts = {0: None, 1: "", 2: "one", 3: "One", 4: "two words"}
    for k in range(5, 60):
        words = list(base) if k % 3 else [f"u{x}" for x in rng.integers(0, 50, 70)]
        for at in rng.integers(0, len(words), k % 5):
            words[at] = f"n{k}"
        texts[k] = " ".join(words)
    frame = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_groups(frame, size, threshold).collect()}
    assert got == jaccard_groups(texts, size, float(threshold))


def test_jaccard_odd_rows(spark, odd):
    found = jaccard_join.link_groups(odd).collect()
    assert len(found) == len(ODD) + 2 and {r.component_id for r in found if r.doc_id is None} == {None}
    assert jaccard_join.link_groups(odd.where("doc_id = -1")).count() == 0


@pytest.mark.parametrize("rounds", [0, 3])
def test_jaccard_near_misses_and_long_chains(spark, monkeypatch, rounds):
    # copies of one text that miss the threshold with most others, and a chain whose ends are unlike
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    rng = random.Random(4)
    base, texts = [f"t{k}" for k in range(120)], {}
    for k in range(150):
        words = list(base)
        for at in rng.sample(range(120), rng.randint(0, 5)):
            words[at] = f"n{k}x{at}"
        texts[k] = " ".join(words[: rng.randint(112, 120)])
    chain = [f"c{k}" for k in range(100)]
    for k in range(150, 180):
        texts[k] = " ".join(chain)
        chain = [*chain[2:], f"e{k}", f"f{k}"]
    frame = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_groups(frame, 3, "0.9").collect()}
    assert got == jaccard_groups(texts, 3, 0.9)


def test_jaccard_pairs_of_the_last_round_grow_with_the_links_only(spark):
    def pairs(count):
        rng = random.Random(9)
        texts = []
        for k in range(count):
            words = [f"t{x}" for x in range(400)]
            for at in rng.sample(range(400), rng.randint(4, 6)):
                words[at] = f"n{k}x{at}"
            texts.append((k, " ".join(words)))
        share = Fraction("0.9")
        rows = spark.createDataFrame(texts, "doc_id long, text string")
        table = spark.sparkContext.broadcast(jaccard_join._count_table(rows, 3))
        sets = jaccard_join._sets(rows, 3, share, table)
        here = sets.select(F.col("doc_id").alias("d"), F.col("n").cast("int"), F.posexplode("prefix").alias("p", "token"), F.col("doc_id").alias("component"))
        return jaccard_join._all_pairs(here, sets, share).count(), sum(len(a & b) >= 0.9 * len(a | b) for a, b in itertools.combinations([{*zip(w, w[1:], w[2:])} for w in (t.split() for _, t in texts)], 2))

    made, linked = pairs(100)
    assert linked <= made <= 1.05 * linked + 100


def test_jaccard_meeting_elements_move_once_and_only_sets_of_fitting_sizes_meet(spark):
    rng = random.Random(3)
    sets = [(k, rng.randint(1, 40), rng.sample(range(60), rng.randint(0, 12))) for k in range(80)]
    share = Fraction("0.8")
    found = jaccard_join._meeting(spark.createDataFrame(sets, "doc_id long, n long, prefix array<long>"), share)
    every = [(t, d, n, p) for d, n, prefix in sets for p, t in enumerate(prefix)]
    want = {x for x in every if any(x[0] == y[0] and x[1] != y[1] and min(x[2], y[2]) >= share * max(x[2], y[2]) for y in every)}
    rows = [tuple(r) for r in found.select("token", "d", "n", "p").collect()]
    assert len(rows) == len(want) < len(every) and {*rows} == want
    assert found._jdf.queryExecution().sparkPlan().toString().count("Window") == 1
    planned = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in planned and planned.split("Initial Plan")[-1].count("Exchange hashpartitioning(token") == 1


def test_jaccard_verification_sends_texts(spark):
    texts = [(1, "a b c d e f g h i j"), (2, "A b c d e f g h i j"), (3, "a b c d e f g h i k"), (4, None), (5, "x y")]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (4, 5)], "a long, b long")
    found = jaccard_join._verified(pairs, rows, 3, Fraction("0.9"))
    assert [(r.a, r.b) for r in found.collect()] == [(1, 2)]
    # texts are read by the check itself: no step before it makes sets of hashes
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_jaccard_centre_pairs_compare_plain_columns(spark):
    """Structs as operands of least and greatest make code whose compilation takes an executor half a gigabyte."""
    rows = [(t, d, 5 + d % 3, (d + t) % 4, d) for t in range(3) for d in (7, 2, 9, 4)]
    here = spark.createDataFrame(rows, "token long, d long, n int, p int, component long")
    pairs = jaccard_join._centre_pairs(here, 0)
    at = {(t, d): (n, p) for t, d, n, p, _ in rows}
    # the smallest id, the smallest and the largest set
    centres = {min(d for _, d in at), min(at, key=lambda k: (at[k][0], k[1]))[1], min(at, key=lambda k: (-at[k][0], k[1]))[1]}
    want = {(min(d, c), max(d, c), at[t, min(d, c)], at[t, max(d, c)]) for t, d in at for c in centres if c != d}
    assert {(r.a, r.b, (r.na, r.pa), (r.nb, r.pb)) for r in pairs.collect()} == want and pairs.count() == len(want)
    code = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "least(struct" not in code and "least(named_struct" not in code and "least(x" not in code and "greatest(struct" not in code


def test_decontamination(spark, odd):
    bench = spark.createDataFrame([(1, "One two THREE four five six seven eight nine ten eleven"), (2, "short item"), (3, None), (4, "...")], "item_id long, text string")
    texts = ["x. One, two three-four five six seven eight nine ten! y", "a Short ITEM b short item", "one two three", None]
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, spans int")
    found = {r.doc_id: r for r in decontaminate.find_overlap(docs, bench, block_bytes=40).collect()}
    assert found[0].spans == [[1, 11]] and found[0].items == [1] and found[1].spans == [[1, 3], [4, 6]] and not found[2].spans and found[3].n_words == 0
    assert {r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()} == {2, 3}
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, "spans").collect()}
    assert cut[0] == "x. ! y" and cut[1] == "a  b " and cut[2] == texts[2] and cut[3] is None
    assert decontaminate.find_overlap(odd, bench.where("item_id = 9")).where("size(spans) > 0").count() == 0


def test_chat_windows(spark):
    talk = [(1, 0, "system", "be <s>kind"), *[(1, k, ("user", "assistant")[k % 2 == 0], f"turn {k} \\ [INST] " + "z" * 300) for k in range(1, 40)], (2, 0, None, None), (None, 0, "assistant", "<|im_end|>\n")]
    frame = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    windows = chat_format.format_windows(frame, budget=2048).orderBy("conv_id", "window").collect()
    assert not any(x in w.text.replace(chat_format.BEGIN, "").replace(chat_format.END, "") for w in windows for x in ("<s>", "[INST]", "<|im_end|>"))
    one = [w for w in windows if w.conv_id == 1]
    assert len(one) > 3 and all(w.text.startswith("<|im_start|>system\n") for w in one) and all(w.n_repeated >= 2 for w in one[1:])
    read = chat_format.digests(chat_format.read_windows(chat_format.format_windows(frame, budget=2048))).collect()
    got = {r.conv_id: r for r in read}
    learned = "".join(t for c, _, r, t in talk if c == 1 and r == "assistant")
    assert got[1].n_turns == 40 and got[1].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest() and got[2].n_turns == 1 and got[None].loss_chars == 11
    assert chat_format.format_windows(frame.where("turn < 0")).count() == 0


def test_packages_are_zip_files(tmp_path):
    file = tmp_path / "a.zip"
    with file.open("wb") as out:
        w = warc_zip.PackageWriter(out)
        w.add("archive/x", [b"abc", b"def"])
        w.add("y", [])
        w.close()
    with zipfile.ZipFile(file) as z:
        assert z.testzip() is None and z.read("archive/x") == b"abcdef"
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("plain", b"0123456789")
        z.writestr("packed", b"0" * 99, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 note"
    for name, member, want in (("a.zip", "archive/x", b"cde"), ("b.zip", "plain", b"234")):
        with (tmp_path / name).open("rb") as raw:
            raw.size = None
            size = (tmp_path / name).stat().st_size
            source = type("S", (), {"size": size, "seek": raw.seek, "read": raw.read})
            package = warc_zip.Package(source)
            assert package.range(member, 2, 3) == want and "packed" not in package.members
            with pytest.raises(ValueError):
                package.range(member, 2, 99)


def test_packages_of_pages(spark, tmp_path):
    same = "é" * 600
    pages = [(1, "http://a/", same), (2, None, same), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (None, "u", same), (2, None, same)]
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, target string")
    folder, files = warc_zip.write_packages(frame, str(tmp_path / "w"), package_bytes=1500)
    read = [(r.record_id, r.kind, r.size, r.refers_to) for r in warc_zip.read_records(folder, warc_zip.locate(folder, files)).collect()]
    assert sorted(read, key=str) == sorted([("1", "revisit", 1200, "2"), ("2", "response", 1200, None), ("2", "response", 1200, None), ("3", "response", 5, None), ("4", "response", 5, None), ("5", "response", 0, None), (None, "response", 1200, None)], key=str)


def test_packages_of_other_writers(spark, tmp_path):
    def put(file, members, packed=()):
        with zipfile.ZipFile(tmp_path / file, "w") as z:
            for name, data in members:
                z.writestr(name, data, zipfile.ZIP_DEFLATED if name in packed else zipfile.ZIP_STORED)

    def archive(names):
        records = [gzip.compress(warc_zip.record("response", n, n.encode(), {"X-Payload-Length": str(len(n)), "WARC-Payload-Digest": "sha1:x"})) for n in names]
        lines = [json.dumps({"offset": sum(map(len, records[:k])), "length": len(r)}) for k, r in enumerate(records)]
        return b"".join(records), "\n".join(lines)

    (a, at), (b, bt) = archive(["1", "22"]), archive(["333"])
    both = [("archive/crawl-a.warc.gz", a), ("indexes/crawl-a.jsonl", at), ("archive/b.warc.gz", b), ("indexes/b.idx", bt), ("datapackage.json", "{}")]
    put("two.zip", both)
    files = lambda *names: spark.createDataFrame([(n,) for n in names], "file string")
    places = warc_zip.locate(str(tmp_path), files("two.zip"))
    assert {r.member for r in places.collect()} == {"archive/crawl-a.warc.gz", "archive/b.warc.gz"}
    assert sorted((r.record_id, bytes(r.payload)) for r in warc_zip.read_records(str(tmp_path), places).collect()) == [("1", b"1"), ("22", b"22"), ("333", b"333")]
    put("one.zip", [("archive/data.warc.gz", b), ("indexes/index.jsonl", bt)])
    assert [r.member for r in warc_zip.locate(str(tmp_path), files("one.zip")).collect()] == ["archive/data.warc.gz"]
    put("packed.zip", both, packed={"archive/b.warc.gz"})
    put("bare.zip", both[:3])
    put("none.zip", both[4:])
    for name, why in (("packed.zip", "archive/b.warc.gz is compressed"), ("bare.zip", "archive/b.warc.gz has no index"), ("none.zip", "no archive members")):
        with pytest.raises(Exception, match=f"{name}: {why}"):
            warc_zip.locate(str(tmp_path), files(name)).collect()


def test_toxicity_learns_marker_words(spark):
    rng = np.random.default_rng(1)
    docs = []
    for k in range(400):
        words = [f"w{x}" for x in rng.integers(0, 300, 60)]
        if k % 4 == 0:
            words[int(rng.integers(60))] = ("vile", "foul")[k % 8 == 0]
        docs.append((k, " ".join(words), "en" if k % 3 else None, int(k % 4 == 0)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, toxic int")
    model = toxicity.train(frame, frame, F.col("doc_id") < 300)
    got = {r.doc_id: r.score for r in toxicity.score(frame, model).collect()}
    assert np.mean([(got[k] >= 0.5) == (k % 4 == 0) for k in range(300, 400)]) > 0.95
    kept = toxicity.keep_clean(frame, model).collect()
    clash = toxicity.keep_clean(frame.withColumn("__cut", F.lit("x")), model)
    assert clash.columns == [*frame.columns, "__cut"] and clash.count() == len(kept) and toxicity.keep_clean(frame.where("doc_id < 0"), model).count() == 0
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "toxic"} and np.mean([r.toxic for r in kept]) < 0.03
    long = spark.createDataFrame([(1, "w1 " * 120_000 + "vile"), (2, None), (3, "")], "doc_id long, text string")
    found = {r.doc_id: r.score for r in toxicity.score(long, model).collect()}
    assert found[1] > 0.5 > found[2] == found[3]
    alone = toxicity.train(frame, frame.where("toxic = 5"), F.lit(True))
    assert len({r.score for r in toxicity.score(frame, alone).collect()}) == 1


def test_toxicity_uses_every_labelled_row(spark, monkeypatch):
    """Each shard's rows and words of any place in a text count, and so do rows beyond any number."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 40)
    monkeypatch.setattr(toxicity, "SHARD_LEAST", 10)
    monkeypatch.setattr(toxicity, "STEPS", 200)
    rng = np.random.default_rng(3)
    docs = [(k, " ".join(f"w{x}" for x in rng.integers(0, 50, 30)) + (" vile" if k % 6 == 0 else ""), "en", int(k % 6 == 0)) for k in range(300)]
    # the only texts with the second marker are longer than a sample's rows were
    docs += [(k, "w1 " * 21_000 + "foul", "en", 1) for k in range(300, 316)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, toxic int")
    ids = frame.selectExpr("doc_id", "toxic as label")
    rows = toxicity.labelled_words(frame.drop("toxic"), ids.where("doc_id % 2 = 0").unionByName(ids.where("doc_id = 4"))).cache()
    assert rows.count() == 159 and sorted(len(r.words) // 4 for r in rows.collect()) == sorted(len(t.split()) for k, t, *_ in [*docs, docs[4]] if k % 2 == 0)
    learn = toxicity.labelled_words(frame.drop("toxic"), ids).where("not held").cache()
    sizes = [learn.where(f"label = {c}").count() for c in (0, 1)]
    known = toxicity.vocabulary(learn, 4)
    assert {zlib.crc32(w) for w in (b"vile", b"foul", b"w1")} <= set(known.tolist())
    packed = toxicity.shards(learn, known, sizes, 0).collect()
    assert len(packed) == -(-sizes[0] // 40) and sum(r.labels.count(0) for r in packed) == sizes[0]
    assert all(r.labels.count(1) and len(r.labels) == len(r.sizes) // 8 and sum(np.frombuffer(r.sizes, np.int64)) == len(r.words) // 4 for r in packed)
    short = frame.where("doc_id < 300")
    model = toxicity.train(short, short, F.lit(True))
    got = {r.doc_id: r.score for r in toxicity.score(short, model).collect()}
    assert np.mean([(got[k] >= 0.5) == bool(y) for k, _, _, y in docs[:300]]) > 0.95


def test_toxicity_rounds_move_sums_of_tasks(spark, monkeypatch):
    """The weights after a round are the mean of all shards' own, and a task sends them once for all of its shards."""
    monkeypatch.setattr(toxicity, "ROUNDS", 1)
    monkeypatch.setattr(toxicity, "STEPS", 4)
    rng, known = np.random.default_rng(5), np.arange(600, dtype=np.uint32)
    texts = [[rng.integers(0, 601, 25).astype(np.uint32) for _ in range(8)] for _ in range(23)]
    rows = [(k, 4, bytes([0, 1] * 4), np.array([25] * 8, np.int64).tobytes(), b"".join(t.tobytes() for t in own)) for k, own in enumerate(texts)]
    packed = spark.createDataFrame(rows, "shard long, most long, labels binary, sizes binary, words binary").repartition(12)
    want = []
    for k, own in enumerate(texts):
        state = toxicity._Fit.new(known, 7)
        toxicity.advance(state, own, np.array([0, 1] * 4, np.uint8), 0, 4, [7, k])
        want.append(state.flat().astype(np.float64))
    seen, write = [], toxicity.staged

    def spy(df):
        seen.append(write(df))
        return seen[-1]

    monkeypatch.setattr(toxicity, "staged", spy)
    got = toxicity.fit(packed, known)
    assert np.allclose(got.embedding.ravel(), np.mean(want, axis=0)[: got.embedding.size], atol=1e-7) and len(seen) == 1
    state = spark.sparkContext.broadcast(toxicity._Fit.new(known, 7))
    moved = toxicity.changes(packed, state, 4, 0, 7).collect()
    chunks = -(-len(want[0]) // toxicity.CHUNK)
    assert chunks > 1 and len(moved) <= 4 * chunks and sum(r.shards for r in moved if r.chunk == 0) == 23


def test_url_rules(spark):
    urls = [None, "nothing", "http://x.example.com/en/a?b", "http://WWW.Example.com/en/", "https://badexample.com/en/", "http://a.net/es", "http://a.net/es/#x", "http://com/x", "http://x.org/ads/banner.gif"]
    frame = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = [*queries.URL_RULES, url_rules.Rule("block", "*", "/*banner"), url_rules.Rule("allow", "x.org", "/ads/banner.gi")]
    want = [None, None, "example.com/en/", "www.example.com/en/", "com/", None, "net/es/", "com/", "x.org/ads/banner.gi"]
    for block in (100, 2):
        assert [r.rule for r in url_rules.judge(frame, rules, block_rules=block).orderBy("page_id").collect()] == want


def test_chat_history_of_long_and_uneven_turns(spark):
    rng = random.Random(5)
    sizes = (1, 3, 20, 90, 100, 200, 500, 800, 3000)
    talk = [(1, 0, "system", "s" * 80), (1, 1, "user", "q" * 400), (1, 2, "assistant", "a" * 3200)]
    for conv, step in ((2, 1), (3, 1), (4, 100), (5, 300), (None, 300)):
        talk += [(conv, k * step, "system" if k == 0 and conv != 3 else ("user", "assistant")[k % 2], f"{conv} {k} " + "x" * 4 * rng.choice(sizes)) for k in range(60)]
    frame = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    want = {}
    for conv in {t[0] for t in talk}:
        at, turns = 0, []
        for _, _, role, text in sorted(t for t in talk if t[0] == conv):
            turns.append((at, at + (len(text) + 3) // 4 + 4, f"<|im_start|>{role}\n{text}<|im_end|>\n", role))
            at = turns[-1][1]
        lead = turns[0][3] == "system"
        for window in {(t[1] - 1) // 768 for t in turns}:
            own = [k for k, t in enumerate(turns) if (t[1] - 1) // 768 == window]
            back = own[0]
            while back > lead and turns[own[0]][0] - turns[back - 1][0] <= 256:
                back -= 1
            head = [turns[0][2]] if lead and own[0] > 0 else []
            want[conv, window] = ("".join(head + [t[2] for t in turns[back : own[-1] + 1]]), len(head) + own[0] - back)
    got = {(r.conv_id, r.window): (r.text, r.n_repeated) for r in chat_format.format_windows(frame, budget=2048).collect()}
    assert got == want and got[1, 1][1] == 2


def test_token_queries_equal_the_library(spark, library):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    ids = {k: library.encode(t, add_special_tokens=False).ids for k, t in docs}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    run = {name: {r.doc_id: r for r in queries.QUERIES[name](spark, SF).collect()} for name in ("op6_token_counts", "op7_bpe_codec", "op9_token_files")}
    assert all(len(found) == len(docs) for found in run.values())
    start = 0
    for k, text in docs:
        six, seven, nine = (found[k] for found in run.values())
        assert (six.n_bytes, six.n_tokens, six.over_limit) == (len(text.encode()), len(ids[k]), len(ids[k]) > 512)
        assert (seven.n_tokens, seven.ids_sha256, seven.decoded_sha256) == (len(ids[k]), sha(",".join(map(str, ids[k]))), sha(library.decode(ids[k], skip_special_tokens=False)))
        assert (nine.start, nine.n_tokens, nine.ids_crc32) == (start, len(ids[k]) + 1, zlib.crc32(np.array([*ids[k], 0], "<u4").tobytes()))
        start += len(ids[k]) + 1
