"""Every dealt operator on odd rows, and against brute force or the library that it must equal."""

import hashlib
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from beaconmill.llm import align, bpe, common, langid, linedup, packing, pii, quality, queries, simhash, topk, toxicity, winnow
from beaconmill.llm.words import words_of

SF = "/root/testdata/sf0.001"
LONG = "word after word, and a line.\n" * 6000
MAIL = "write to a.b7@mail1.example.com or +1 (640) 555-0953 now"
TEXTS = [None, "", "   \n\t ", "a", "ñandú’s œuvre ½²x 你好 😀 <|endoftext|> tail  ", MAIL, MAIL, LONG, "the the the the the the", "Ünïcödé straße ΣΑΣ\x1c\x85x"]
# names that the operators use themselves
CLASH = ["fp", "part", "hash", "own", "of", "at", "new", "hashed", "ours", "y", "doc", "pos", "score", "predicted", "stats", "lines_dropped", "entities_replaced", "lang_pred", "shares", "nth", "id", "line"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, "s", 1) for i, t in enumerate(TEXTS)]
    rows += [(None, MAIL, "de", None, None), (None, MAIL, "de", None, None), (5, MAIL, "en", "s", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.select("*", *(F.lit("x").alias(c) for c in CLASH)).repartition(3)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.filter("false")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(10)] + [(None, 1, 1), (3, None, None), (77, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def ordered(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---------------------------------------------------------------- 1 and 10: tokens


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_the_librarys(docs, name):
    path = public_tokenizers.path(name)
    own, theirs = words_of(path), Tokenizer.from_file(path)
    texts = [t or "" for t in TEXTS] + [r[0] for r in docs.select("text").collect()]
    texts += ["it's I'LL don't", "a<|startoftext|>b<|endoftext|>", " lead", "tail \n", "é x y z", "١٢٣ ⅷ ª"]
    for text in texts:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids, text[:80]


@pytest.mark.parametrize("most_common", [1, 50, 1 << 20])
def test_bpe_equals_library(odd, docs, most_common):
    table = odd.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc_id, text in table.collect():
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        back = theirs.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back))))
    assert ordered(bpe.digests(bpe.encode_documents(table, most_common=most_common))) == sorted(want, key=repr)


def test_common_words_are_bounded(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    table, total = bpe.common_words(docs, path, 50)
    found = table.collect()
    counts = Counter(w for r in docs.select("text").collect() for w in words_of(path).split(r.text))
    assert total == counts.total()
    assert len(found) <= 50
    assert {r.word for r in found} <= {w for w, n in counts.items() if n >= total / 50}


def test_bpe_of_nothing(empty):
    assert bpe.digests(bpe.encode_documents(empty)).collect() == []


def test_decoding_replaces_broken_utf8():
    path = public_tokenizers.path("byte_bpe_50k.json")
    theirs = Tokenizer.from_file(path)
    ids = theirs.encode("😀é", add_special_tokens=False).ids
    for part in (ids[1:], ids[:-1], ids[:1]):
        assert bpe.decode_ids(np.array(part, "<u4").tobytes(), path) == theirs.decode(part, skip_special_tokens=False)


def check_packing(pieces, table, size):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for (t,) in table.select("text").collect()))
    # rows that share an id cannot be told apart by it, so all the ids are compared by their checks
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for members in sequences.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    assert sum(p.length for p in pieces) == sum(map(len, want))
    single = {r.doc_id: r.text for r in table.select("doc_id", "text").collect()}
    counts = table.groupBy("doc_id").count().collect()
    for doc_id in (r.doc_id for r in counts if r["count"] == 1):
        ids = [*tokenizer.encode(single[doc_id] or "", add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            part = np.array(ids[at : at + p.length], "<u4").tobytes()
            assert (p.start, p.ids_crc32, p.doc_tokens) == (at, zlib.crc32(part), len(ids))
            at += p.length
        assert at == len(ids)
    return sequences


@pytest.mark.parametrize(("size", "windows", "fan"), [(4096, 16, 32), (64, 3, 2)])
def test_packing(odd, docs, size, windows, fan):
    table = odd.select("doc_id", "text").unionByName(docs.select("doc_id", "text")).repartition(5)
    pieces = packing.pack(table, size=size, windows=windows, fan=fan, slack=size // 128).collect()
    sequences = check_packing(pieces, table, size)
    used = [sum(p.length for p in s) for s in sequences.values()]
    padding = sum(size - n for n in used if n & (n - 1))
    assert padding <= 0.02 * size * len(used)


def test_packing_of_nothing(empty):
    assert packing.pack(empty).collect() == []


# ---------------------------------------------------------------- 2, 3 and 5: models


def held_out(docs, labels, target):
    return docs.join(labels, "doc_id").filter((F.crc32(F.col("doc_id").cast("string")) % 3) == 1).select(F.col(target).alias("truth"), "score", "predicted").toPandas()


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    stats = quality.with_statistics(docs.select("doc_id", "text"))
    found = held_out(quality.score_quality(stats, quality.fit_quality(stats, labels)), labels, "quality")
    assert (found.truth == found.predicted).mean() > 0.95


def test_quality_density_is_gaussian():
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    a = rng.normal(size=(d, d))
    cov, mean = a @ a.T + np.eye(d), rng.normal(size=d)
    factor = np.linalg.cholesky(cov)
    one = (0.0, mean, np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum())
    model = quality.Discriminant(np.zeros(d), np.ones(d), [one, one], 1.0)
    x = rng.normal(size=(5, d))
    want = [-0.5 * (np.linalg.slogdet(cov)[1] + (r - mean) @ np.linalg.solve(cov, r - mean)) for r in x]
    assert np.allclose(model.log_density(x, 0), want)


def test_quality_on_odd_rows(odd, empty, labels):
    for known in (labels, labels.filter("false"), labels.filter("quality = 1")):
        stats = quality.with_statistics(odd)
        out = quality.score_quality(stats, quality.fit_quality(stats, known)).collect()
        assert len(out) == odd.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    stats = quality.with_statistics(empty)
    assert quality.score_quality(stats, quality.fit_quality(stats, labels)).collect() == []


def test_machine_sums_over_pairs():
    rng = np.random.default_rng(2)
    m = toxicity.Machine(np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    x = rng.normal(size=(4, 6))
    pairs = [sum(m.factors[i] @ m.factors[j] * r[i] * r[j] for i, j in combinations(range(6), 2)) for r in x]
    assert np.allclose(m.margin(x), 0.3 + x @ m.linear + pairs)


def test_machine_learns_what_no_sum_of_weights_can(spark):
    # an insult alone and a group alone are clean, both together are not; and neither is clean
    rows, n = [], 0
    for n in range(600):
        rows.append((n, " ".join(["some", "plain", "words"] + ["oaf"] * (n % 4 in (1, 3)) + ["tribe"] * (n % 4 in (2, 3))), int(n % 4 == 3)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    machine = toxicity.fit_toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    found = held_out(toxicity.score_toxicity(table.select("doc_id", "text"), machine), table.select("doc_id", "toxic"), "toxic")
    assert (found.truth == found.predicted).all()


def test_pairs_of_words_tell_among_thousands(spark):
    """Toxic only with an insult and a group together, or with a rare plain marker; each alone is clean."""
    rng = np.random.default_rng(3)
    vocabulary = np.array(["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(5000)])
    share = 1 / np.arange(1, 5001) ** 0.8
    rows = []
    for n in range(6000):
        said = list(rng.choice(vocabulary, 60, p=share / share.sum()))
        said += ["stupid"] * (n % 8 in (0, 1)) + ["martians"] * (n % 8 in (0, 2)) + ["vilemark"] * (n % 16 == 3)
        rows.append((n, " ".join(rng.permutation(said)), int(n % 8 == 0 or n % 16 == 3), "both" if n % 8 == 0 else "one" if n % 8 in (1, 2) else "mark" if n % 16 == 3 else "none"))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int, what string")
    machine = toxicity.fit_toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    found = toxicity.score_toxicity(table, machine).filter((common.remainder("doc_id", 3) == 1)).groupBy("what").agg(F.avg("predicted")).collect()
    share = dict(map(tuple, found))
    assert share["both"] > 0.9 and share["mark"] > 0.9 and share["one"] < 0.1 and share["none"] < 0.01


def test_sparse_margins_equal_dense_ones():
    rng = np.random.default_rng(4)
    dense = np.where(rng.random((7, 9)) < 0.4, rng.normal(size=(7, 9)), 0)
    dense[2] = 0
    at = np.nonzero(dense)
    x = toxicity.Sparse(np.concatenate([[0], np.cumsum((dense != 0).sum(1))]), at[1], dense[at])
    m = toxicity.Machine(np.arange(9), 0.1, rng.normal(size=9), rng.normal(size=(9, 3)))
    assert np.allclose(toxicity.margins(m, x)[0], m.margin(dense))
    assert np.allclose(toxicity.scores(m, x.part(np.array([5, 2, 0]))), m.score(dense[[5, 2, 0]]))


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    machine = toxicity.fit_toxicity(docs, labels)
    found = held_out(toxicity.score_toxicity(docs.select("doc_id", "text"), machine), labels, "toxic")
    assert (found.truth == found.predicted).mean() > 0.95
    assert found.truth[found.predicted == 1].mean() > 0.95


def test_toxicity_on_odd_rows(odd, empty, labels):
    for known in (labels, labels.filter("false"), labels.filter("toxic = 1")):
        out = toxicity.score_toxicity(odd, toxicity.fit_toxicity(odd, known)).collect()
        assert len(out) == odd.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
        assert len({r.score for r in out if not (r.text or "").strip()}) == 1
    assert toxicity.score_toxicity(empty, toxicity.fit_toxicity(empty, labels)).collect() == []


def test_training_sample_is_bounded_and_repeats(spark):
    many = spark.range(20_000).selectExpr("id as doc_id", "int(id % 2) as toxic")
    first, again = (ordered(toxicity.training_labels(many, "toxic", 1000)) for _ in range(2))
    assert first == again
    assert 800 < len(first) < 1200


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.predict_language(docs.select("doc_id", "text"), langid.fit_languages(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    out = found.filter(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.97


def test_language_shares_of_a_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit_languages(docs)
    long = {lang: docs.filter(F.col("lang") == lang).orderBy(F.desc("n_chars")).first().text for lang in ("de", "es")}
    grams, counts = langid.gram_counts(long["de"][:6000] + "\n" + long["es"][:3000])
    shares = dict(zip(model.names, model.proportions(grams, counts), strict=True))
    assert abs(shares["de"] - 2 / 3) < 0.08
    assert abs(shares["es"] - 1 / 3) < 0.08
    assert sum(v > 0 for v in shares.values()) == 2


def test_language_on_odd_rows(odd, empty, spark):
    out = langid.predict_language(odd, langid.fit_languages(odd)).collect()
    assert len(out) == odd.count()
    assert all(0 <= r.score <= 1 for r in out)
    got = langid.predict_language(odd.select("doc_id", "text"), langid.fit_languages(odd)).join(odd.select("doc_id", "text").distinct(), "doc_id")
    for r in got.collect():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")), r
    assert langid.predict_language(empty, langid.fit_languages(empty)).collect() == []
    assert {r.lang_pred for r in langid.predict_language(odd, langid.fit_languages(empty)).collect()} == {"und"}


# ---------------------------------------------------------------- 4: winnowing


def slow_winnow(text, k, window):
    k = min(k, len(text))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    h = [int(winnow.gram_hashes(codes[i : i + k], k)[0]) for i in range(len(text) - k + 1)]
    w = min(window, max(4, len(h) // 8), len(h))
    found = []
    for at in range(len(h) - w + 1):
        low = min(h[at : at + w])
        pick = (low, max(i for i in range(at, at + w) if h[i] == low))
        if not found or found[-1] != pick:
            found.append(pick)
    return found


@pytest.mark.parametrize("text", ["", "a", "abcabcabc", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", MAIL * 9, "ñ你😀" * 30])
def test_winnowing_is_the_definition(text):
    assert [tuple(map(int, r)) for r in winnow.winnow(text, 5, 8)] == (slow_winnow(text, 5, 8) if text else [])


def test_winnowing_in_chunks(monkeypatch):
    text = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(3000))
    whole = winnow.winnow(text, 12, 64)
    monkeypatch.setattr(winnow, "CHUNK", 100)
    assert (winnow.winnow(text, 12, 64) == whole).all()


def test_winnowing_guarantee():
    rng = np.random.default_rng(3)
    shared = "".join(map(chr, rng.integers(97, 123, 75)))  # window + k - 1
    for n in (0, 7, 500):
        a, b = ("".join(map(chr, rng.integers(97, 123, m))) for m in (n, 900))
        assert np.intersect1d(winnow.winnow(a + shared)[:, 0], winnow.winnow(b + shared + b)[:, 0]).size


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_neighbours_follow_in_order_of_ids(odd, docs, parts):
    table = docs.select("doc_id", "text").unionByName(odd.filter("doc_id is not null and not (doc_id = 5)").select(F.col("doc_id") + 10**6, "text").toDF("doc_id", "text"))
    rows = sorted((r.doc_id, r.text or "") for r in table.collect())
    out = {r.doc_id: r for r in winnow.fingerprint_neighbours(table, parts=parts).collect()}
    assert len(out) == len(rows)
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        other, got = winnow.edited(text, after), out[doc_id]
        assert (got.n_chars, got.edited_sha256) == (len(text), hashlib.sha256(other.encode()).hexdigest())
        prints = [winnow.winnow(t) for t in (text, other, after)]
        assert (got.fingerprint, got.edited_fingerprint) == (winnow.written(prints[0]), winnow.written(prints[1]))
        sets = [set(p[:, 0].tolist()) for p in prints]
        like = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        assert (got.near_edited, got.near_next) == tuple(like)


def test_neighbours_on_odd_rows(odd, empty, spark):
    assert winnow.fingerprint_neighbours(odd).count() == odd.count()
    assert winnow.fingerprint_neighbours(empty).collect() == []
    (one,) = winnow.fingerprint_neighbours(spark.createDataFrame([(1, "abcd")], "doc_id bigint, text string")).collect()
    assert one.near_next == 1.0


# ---------------------------------------------------------------- 6: lines


def line_print(line):
    words = line.split(" ")
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(words))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def slow_lines(rows, least_words=5, similarity=0.8):
    import regex

    places, norms = [], {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for pos, line in enumerate((text or "").split("\n") if text is not None else []):
            words = [w for w in regex.split(r"[^\p{L}\p{N}]+", line.lower()) if w]
            if len(words) >= least_words:
                places.append((doc_id, pos, " ".join(words)))
                norms.setdefault(" ".join(words), line_print(" ".join(words)))
    up = simhash.Joined()
    names = sorted(norms)
    for i, j in combinations(range(len(names)), 2):
        a, b = names[i], names[j]
        if (norms[a] ^ norms[b]).bit_count() <= 3 and edits(a.split(), b.split()) <= (1 - similarity) * max(len(a.split()), len(b.split())) + 1e-9:
            up.join(i, j)
    seen, gone = set(), set()
    for doc_id, pos, norm in places:
        root = up.find(names.index(norm))
        gone |= {(doc_id, pos)} if root in seen else set()
        seen.add(root)
    return {(d, p) for d, p in gone}


def line_rows():
    rng = np.random.default_rng(5)
    vocabulary = ["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(400)]
    base = [" ".join(rng.choice(vocabulary, 60)) for _ in range(12)]
    rows = []
    for n in range(60):
        lines = []
        for line in rng.choice(base, 4):
            words = line.split(" ")
            for _ in range(rng.integers(0, 3)):
                words[rng.integers(len(words))] = rng.choice(vocabulary)
            lines.append(" ".join(words) if n % 2 else " ".join(words).upper() + " !")
        rows.append((n, "\n".join([*lines, "", "too short", " ".join(rng.choice(vocabulary, 12))])))
    return rows + [(70, " ".join(vocabulary[:300])), (71, " ".join([*vocabulary[:299], "other"]))]


def test_lines_equal_brute_force(spark):
    rows = line_rows()
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = slow_lines(rows)
    assert len(want) > 60
    assert {tuple(r) for r in linedup.line_drops(table).collect()} == want
    out = {r.doc_id: r for r in linedup.deduplicate_lines(table).collect()}
    for doc_id, text in rows:
        kept = [line for pos, line in enumerate(text.split("\n")) if (doc_id, pos) not in want]
        assert out[doc_id].text == "\n".join(kept)
        assert out[doc_id].lines_dropped == len(text.split("\n")) - len(kept)


def test_lines_on_odd_rows(odd, empty):
    out = linedup.deduplicate_lines(odd)
    assert out.columns == [c for c in odd.columns if c != "lines_dropped"] + ["lines_dropped"]
    rows = out.collect()
    assert len(rows) == odd.count()
    assert {r.text for r in rows if r.doc_id == 0} == {None}
    assert {r.text for r in rows if r.doc_id == 1} == {""}
    (long,) = [r for r in rows if r.doc_id == 7]
    assert long.lines_dropped == 5999
    assert linedup.deduplicate_lines(empty).collect() == []
    with pytest.raises(ValueError, match="bits"):
        linedup.deduplicate_lines(odd, max_bits=4)


def test_lines_of_rows_that_share_an_id(spark):
    said = "this very line is said twice over in the corpus"
    own = [f"only row number {n} of all has words like w{n}a w{n}b w{n}c w{n}d" for n in range(8)]
    rows = [(None, f"{own[n]}\n{said}") for n in range(3)] + [(7, f"{said}\n{own[3]}"), (7, f"{own[4]}\n{own[5]}")]
    rows += [(8, " ".join(f"w{i}" for i in range(100)))] * 3  # three times 100 words in lanes of a byte
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = linedup.deduplicate_lines(table).collect()
    lines = [line for r in out for line in r.text.split("\n")]
    assert sorted(line for line in lines if line.startswith("only")) == own[:6]
    assert lines.count(said) == 1
    assert sum(r.lines_dropped for r in out) == 3
    prints = linedup._prints(linedup._lines(table.filter("doc_id = 8"), "doc_id", "text"), 5).collect()
    assert [r.n for r in prints] == [100]


def test_near_copies_keep_other_texts_of_an_id(spark):
    rows = [(7, "a text of its own about the weather in the mountains today"), (7, "quite another text that tells of ships and harbours far away"), (9, "a third one")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert ordered(corpus_pipeline.drop_near_copies(spark, table, "")) == sorted(rows, key=repr)


def test_short_lines_and_scripts_without_spaces(spark, tmp_path):
    base = "这一行文字在整个语料库里出现了很多次所以应该删除"
    rows = [(1, f"All rights reserved\nok\n{base}"), (2, f"all rights reserved!\nall rights kept\n{base}"), (3, "OK.\n你好\n\n--"), (4, "你好\n\n--"), (5, f"{base}吗")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r.text for r in queries.op6_line_dedup(spark, str(tmp_path)).collect()}
    assert out == {1: rows[0][1], 2: "all rights kept", 3: "你好\n\n--", 4: "\n--", 5: out[5]}
    lines = linedup._prints(linedup._lines(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text"), 5).collect()
    assert sorted((r.doc, r.n) for r in lines) == [(1, len(base)), (2, len(base)), (5, len(base) + 1)]


def test_long_lines_that_share_runs_only_are_not_compared(spark, monkeypatch):
    """A hundred words in common of 180 each: the sketch has room for the others."""
    rng = np.random.default_rng(9)
    common_run = " ".join(f"c{i}" for i in range(100))
    lines = [" ".join([common_run, *(f"{int(w)}" for w in rng.integers(1_000_000, size=80))]) for _ in range(20)]
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    similar, seen = linedup._similar, []

    def counted(texts, pairs, similarity):
        seen.append(pairs.count())
        return similar(texts, pairs, similarity)

    monkeypatch.setattr(linedup, "_similar", counted)
    assert linedup.line_drops(table, max_bits=None).collect() == []
    assert sum(seen) == 0


def pairs_met(monkeypatch):
    """How many rows of pairs come to each comparison of texts, and how many different ones."""
    similar, seen = linedup._similar, []

    def counted(texts, pairs, similarity):
        seen.append((pairs.count(), pairs.distinct().count()))
        return similar(texts, pairs, similarity)

    monkeypatch.setattr(linedup, "_similar", counted)
    return seen


def test_lines_of_equal_words_that_occur_more_often_are_not_compared(spark, monkeypatch):
    """Forty words in common, ten of them four times more in each line, ten others in each: whether their number is even says nothing."""
    rng = np.random.default_rng(10)
    run = [f"c{i}" for i in range(40)]
    lines = [" ".join([*run, *rng.permutation(run[at : at + 10] * 4)]) for at in range(0, 40, 10)]
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    seen = pairs_met(monkeypatch)
    assert linedup.line_drops(table, max_bits=None).collect() == []
    assert sum(n for n, _ in seen) == 0


@pytest.mark.parametrize("n", [12, 40])
def test_lines_of_crowded_keys_are_linked_and_meet_about_once(spark, monkeypatch, n):
    """Copies of a line that is not there itself, with as many changes, repeated words too, as leave some pairs similar."""
    rng = np.random.default_rng(n)
    base = [f"b{i % (n - 3)}" for i in range(n)]
    lines = []
    for _ in range(60):
        words = list(base)
        for at in rng.permutation(n)[: rng.integers(n // 10, n // 5 + 2)]:
            words[at] = f"x{rng.integers(40)}" if at % 4 else f"b{rng.integers(n)}"
        lines.append(" ".join(words[int(rng.integers(2)) :]))
    lines = sorted(set(lines))
    up, linked = simhash.Joined(), 0
    for i, j in combinations(range(len(lines)), 2):
        a, b = lines[i].split(), lines[j].split()
        if edits(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
            linked += 1
            up.join(i, j)
    want = {i for i in range(len(lines)) if up.find(i) != i}
    assert 10 < linked < 900 and want
    monkeypatch.setattr(linedup, "CROWD", 4)
    seen = pairs_met(monkeypatch)
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    assert {r.doc for r in linedup.line_drops(table, max_bits=None).collect()} == want
    rows, pairs = seen[-1]
    assert rows <= 3 * pairs


def test_fingerprints_of_a_chain_are_connected_to_the_smallest(spark):
    """Each of 60 fingerprints is near the one before it only: one star comes out, not a chain of as many edges."""
    chain = [((1 << i) - 1) << 4 for i in range(0, 60, 3)]
    prints = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in chain], "fp bigint")
    found = simhash.near_edges(prints, shard_size=256).collect()
    up = simhash.Joined()
    for r in found:
        up.join(r.a & 0xFFFFFFFFFFFFFFFF, r.b & 0xFFFFFFFFFFFFFFFF)
    assert {up.find(v) for v in chain} == {0}
    joined = simhash.Joined()
    for a, b in zip(chain[1:], chain, strict=False):
        joined.join(a, b)
    assert {b for _, b in joined.stars()} == {0} and len(joined.stars()) == len(chain) - 1


@pytest.mark.parametrize("text", ["a", "a b", " a b", "a  b", "a \n b", "a\n b c", "a\u3000 b", "a\x1f b", "a b ", " ", "  ", "\n", "a\tb c", "é ñ 中 文"])
def test_chunks_of_alignment_are_those_of_the_pattern(text):
    assert [" " + c for c in align.chunks(text)] == align._CUT.split(" " + text)


def test_all_similar_lines_are_linked(spark):
    """Links by edit similarity alone, of lines with as many edits as it allows."""
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(60)]
    lines = []
    for n in [5, 6, 9, 10, 14, 15, 19, 20, 31, 50, 100] * 2:
        base = list(rng.choice(vocabulary, n))
        for edit in ("change", "leave out", "put in", "mixed"):
            words, most = list(base), int(0.2 * n)
            for i in range(most):
                at, what = int(rng.integers(len(words))), edit if edit != "mixed" else ("change", "leave out", "put in")[i % 3]
                words[at : at + (what != "put in")] = [] if what == "leave out" else [str(rng.choice(vocabulary))]
            lines.append(" ".join(words))
        lines.append(" ".join(base))
    lines = sorted(set(lines))
    order = [int(i) for i in rng.permutation(len(lines))]
    up = simhash.Joined()
    for i, j in combinations(range(len(lines)), 2):
        a, b = lines[order[i]].split(), lines[order[j]].split()
        if min(len(a), len(b)) >= 5 and abs(len(a) - len(b)) <= 0.2 * max(len(a), len(b)) and edits(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
            up.join(i, j)
    want = {i for i in range(len(lines)) if up.find(i) != i}
    table = spark.createDataFrame([(i, lines[n]) for i, n in enumerate(order)], "doc_id bigint, text string")
    assert len(want) > 70
    assert {r.doc for r in linedup.line_drops(table, max_bits=None).collect()} == want


@pytest.mark.parametrize("similarity", [0.5, 0.6, 0.7, 0.8, 0.9])
def test_keys_meet_at_any_similarity(spark, similarity):
    """Two lines share a key wherever the edits allow it, short ones and ones of different length too."""
    rng = np.random.default_rng(9)
    rows = []
    for n in [4, 5, 6, 7, 9, 10, 15, 25]:
        for kind in range(6):
            a = [f"w{i}" for i in rng.permutation(200)[:n]]
            b = list(a)
            most = int((1 - similarity) * n + 1e-9)
            for i in range(most):
                at = (i * n // most + n // most // 2) % len(b)  # spread out, so that few runs stay whole
                b[at : at + (kind % 3 < 2)] = [] if kind % 3 == 1 else [f"x{i}"]
            m = max(len(a), len(b))
            if edits(a, b) <= int((1 - similarity) * m + 1e-9):
                rows += [(len(rows), a), (len(rows) + 1, b)]
    words = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "line bigint, norm string")
    texts = words.select("line", linedup._codes().alias("codes"))
    keys = {}
    for r in linedup._keys(texts, similarity).collect():
        keys.setdefault(r.line, set()).add(r.key)
    assert rows and all(keys[i] & keys[i + 1] for i in range(0, len(rows), 2))


def test_lines_without_a_common_run_are_not_sketched_and_steps_leave_no_files(spark, monkeypatch, tmp_path):
    """Sketches are made of lines that share a key only, and what a step has used up goes before the next ones write."""
    own = [" ".join(f"w{n}x{i}" for i in range(20)) for n in range(30)]
    near = [f"{own[0]} once more", own[1].replace("w1x5", "other")]
    table = spark.createDataFrame(list(enumerate(own + near)), "doc_id bigint, text string")
    flipped, seen = linedup._flipped, []

    def counted(texts, parts):
        seen.append(texts.count())
        return flipped(texts, parts)

    monkeypatch.setattr(linedup, "_flipped", counted)
    monkeypatch.setattr(common, "scratch_dir", lambda _, purpose: f"{tmp_path}/{purpose}-{len(list(tmp_path.iterdir()))}")
    assert {r.doc for r in linedup.line_drops(table, max_bits=None).collect()} == {30, 31}
    assert seen == [4]
    left = {p.name.rpartition("-")[0] for p in tmp_path.iterdir()}
    assert not left & {"line-shared", "line-own", "line-near", "line-keyed", "line-pairs", "line-wanted"}


def test_runs_that_a_line_repeats_are_one_key(spark):
    texts = spark.createDataFrame([(0, "ha " * 50 + "ho"), (1, "la lo " * 30), (2, "a b c d e f")], "line bigint, norm string")
    texts = texts.selectExpr("line", "trim(norm) norm").select("line", linedup._codes().alias("codes"))
    rows = [tuple(r) for r in linedup._keys(texts, 0.8).collect()]
    assert len(rows) == len(set(rows)) and {line for line, _ in rows} == {0, 1, 2}


def test_lines_are_brought_into_form_once(spark):
    table = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    plan = linedup._lines(table, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") <= 2  # as Generate and its argument, not in a filter before it


def test_lines_run_no_python(spark):
    table = spark.createDataFrame(line_rows()[:4], "doc_id bigint, text string")
    for df in (linedup.deduplicate_lines(table), pii.replace_pii(table, "k")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# ---------------------------------------------------------------- 7: top k


def slow_top(rows, k, every=20):
    good = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, q in good:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i)
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("block", [3, 2048])
def test_top_k_with_ties_and_odd_vectors(spark, block):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 3) / 4]) for i in range(-40, 260)]
    rows += [(1000 + i, [0.5, 0.5, 0.5]) for i in range(100)]  # many equal vectors
    rows += [(5000, None), (5001, [None, 1.0, 1.0]), (5002, [float("nan"), 1.0, 1.0]), (5003, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit("x")).repartition(5)
    assert {tuple(r) for r in topk.top_k(table, k=7, block=block).collect()} == slow_top(rows, 7)


def test_top_k_of_few_and_none(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-2.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert {tuple(r) for r in topk.top_k(table).collect()} == slow_top(rows, 20)
    assert topk.top_k(table.filter("false")).collect() == []
    assert topk.top_k(table.filter("vec_id > 0")).collect() == []
    assert topk.top_k(table.filter("vec_id = 0")).collect() == []


def test_top_k_over_wide_ranges(spark):
    # ids far above 65,536, all tied; the last bin of a round reaches past its range
    ids = {int(i) for i in np.random.default_rng(331).integers(1, 1_000_000, 1000)}
    rows = [(i, [300.0, -200.0]) for i in sorted(ids | {1_000_000})]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    want = sorted(ids)[:20]
    got = topk.top_k(table, every=1_000_000).orderBy("rank").collect()
    assert [r.vec_id for r in got] == want
    assert [r["rank"] for r in got] == list(range(1, 21))


# ---------------------------------------------------------------- 8: personal data


def replaced(spark, *texts, key="k"):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.text for r in pii.replace_pii(table, key).orderBy("doc_id").collect()]


def shape(text):
    return "".join("9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in text)


def test_surrogates_keep_format_and_coreference(spark):
    texts = ["mail A.b7@Mail1.example.com, again a.b7@mail1.example.com.", "call +1 (640) 555-0953 or 640-555-0953", "card 4238 3974 3689 6688 or 4238397436896688", "ssn 123-45-6789", 'key "dafbac99949115180e7593de87b4492bcef9890b"', "DE44 5001 0517 5407 3249 31"]
    out = replaced(spark, *texts)
    assert list(map(shape, out[:4])) == list(map(shape, texts[:4]))
    mails = [w.strip(".,").lower() for w in out[0].split() if "@" in w]
    assert mails[0] == mails[1] != "a.b7@mail1.example.com"
    assert out[1][6:].replace("(", "").replace(")", "").replace(" ", "-").count(out[1][-12:]) == 2
    card = out[2][-16:]
    assert out[2][5:24].replace(" ", "") == card != "4238397436896688"
    digits = [int(c) for c in reversed(card)]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    assert set(out[4][5:-1]) <= set("0123456789abcdef")
    assert out[5][:2] == "DE"
    assert all(a != b for a, b in zip(texts, out, strict=True))
    assert replaced(spark, *texts) == out != replaced(spark, *texts, key="other")


def test_names_keep_gender_and_script(spark):
    out = replaced(spark, "Mr. John Smith met Mrs. Anna Jones.", "Mr. Smith left.", "Господин Иванов и Госпожа Анна Попова")
    john, smith = out[0].split()[1:3]
    assert john in pii.NAMES["latin m"]
    assert out[0].split()[5] in pii.NAMES["latin f"]
    assert out[1] == f"Mr. {smith} left."
    assert out[2].split()[4] in pii.NAMES["cyrillic f"]
    assert all(0x400 <= ord(c) < 0x500 for c in out[2].split()[1])


def test_surrogates_stay_distinct(spark):
    # two-digit octets and short names are few, so draws collide and are repeated
    texts = [f"ip 10.0.{i // 200}.{i % 200} Mr. {chr(65 + i % 26)}{'abcdefghij'[i // 26 % 10]}{'klmnopqrst'[i // 260]}" for i in range(1500)]
    out = replaced(spark, *texts)
    for at in (1, 3):
        before, after = [t.split()[at] for t in texts], [t.split()[at] for t in out]
        assert len(set(before)) == len(set(after))
        assert not set(before) & set(after)


def test_formats_with_few_values_are_left(spark):
    texts = [f"{a}@{b}.com" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    out = replaced(spark, *texts)
    assert len(set(out)) == len(texts)
    assert not set(out) & set(texts)
    assert all(t.endswith(".com") and t.count("@") == 1 for t in out)


def test_a_format_that_is_used_up_has_longer_surrogates(spark):
    texts = [f"{'_' * 22}{n}{letter}" for n in range(10) for letter in "abcdefghijklmnopqrst"]  # 200 of 260
    out = replaced(spark, *texts, "+100 and +2 50 are no phones, +44 20 7946 0958 is")
    assert len({*texts, *out[:-1]}) == 400
    assert out[-1].startswith("+100 and +2 50 are no phones, +") and "+44 20 7946 0958" not in out[-1]
    found = spark.createDataFrame([("phone", "", f"{n:03}") for n in range(600)], "kind string, grp string, canon string")
    found = found.unionByName(spark.createDataFrame([("phone", "", "6405550953")], found.schema))
    named = pii.surrogates(found, "k")
    rows = named.collect()
    assert len({r.surrogate for r in rows} | {r.canon for r in rows}) == 2 * 601
    table = spark.createDataFrame([("+1 (640) 555-0953", "6405550953", "123456789042"), ("640-555-0953", "6405550953", "123456789042")], "raw string, canon string, s string")
    assert [r[0] for r in table.select(pii._written(F.lit("phone"), F.col("raw"), F.col("canon"), F.col("s"))).collect()] == ["+1 (123) 456-789042", "123-456-789042"]


def test_a_family_has_one_surrogate(spark):
    pieces = ["al", "be", "co", "di", "em", "fa", "gu", "ho"]
    given = [f"{a}{b}".capitalize() for a in pieces for b in pieces[:5]]  # 40, beyond the 16 to choose from
    rows = [("name", "latin m", f"{g} {f}".lower()) for f in ("Smith", "Jones") for g in given] + [("name", "latin", "smith")]
    rows += [("name", "latin", f"{a}{b}{c}{d}") for a in pieces for b in pieces for c in pieces for d in pieces[:3]]  # 1,536 others
    out = pii.surrogates(spark.createDataFrame(rows, "kind string, grp string, canon string"), "k").collect()
    named = {r.canon: r.surrogate for r in out}
    assert len(out) == len(rows) == len(set(named.values()))
    assert not set(named) & set(named.values())
    assert {named[f"{g.lower()} smith"].split()[1] for g in given} == {named["smith"]}
    assert len({named[f"{g.lower()} jones"].split()[1] for g in given}) == 1


def test_pii_on_odd_rows(odd, empty):
    out = pii.replace_pii(odd, "k")
    assert out.columns == [c for c in odd.columns if c != "entities_replaced"] + ["entities_replaced"]
    rows = out.collect()
    assert len(rows) == odd.count()
    assert len({r.text for r in rows if r.entities_replaced}) == 1
    assert sum(r.entities_replaced for r in rows) == 2 * 5
    assert {r.text for r in rows if r.doc_id == 0} == {None}
    assert {r.text for r in rows if r.doc_id == 7} == {LONG}
    assert pii.replace_pii(empty, "k").collect() == []


def test_clean_text_stays(spark):
    clean = ["On 2024-01-02 at 12:30:11 it cost 1,234.50 or 3.5%.", "v1.2.3.4.5 and 1234 5678", "Mr. and Mrs. met", "a@b and @user", "averyveryverylongwordwithoutanydigitinit"]
    assert replaced(spark, *clean) == clean


# ---------------------------------------------------------------- 9: SimHash


def test_tree_finds_all_within():
    rng = np.random.default_rng(6)
    values = [int(x) for x in rng.integers(0, 1 << 12, 400)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in (int(x) for x in rng.integers(0, 1 << 12, 50)):
        assert sorted(tree.within(q, 2)) == sorted({v for v in values if (v ^ q).bit_count() <= 2})


def slow_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("shard_size", [2, 256])
def test_simhash_equals_brute_force(docs, odd, shard_size):
    near = docs.select(F.col("doc_id") + 10**6, F.concat("text", F.lit(" more"))).toDF("doc_id", "text")
    table = docs.select("doc_id", "text").unionByName(near).unionByName(odd.select(F.col("doc_id") + 10**7, "text").toDF("doc_id", "text"))
    rows = [(r.doc_id, slow_print(r.text or "")) for r in table.collect()]
    prints = sorted({p for _, p in rows})
    up = simhash.Joined()
    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 3:
            up.join(a, b)
    least = {}
    for doc_id, p in rows:
        if doc_id is not None:
            least[up.find(p)] = min(doc_id, least.get(up.find(p), doc_id))
    want = sorted([(d, p, least.get(up.find(p))) for d, p in rows], key=repr)
    got = [(r.doc_id, r.fp & 0xFFFFFFFFFFFFFFFF, r.component_id) for r in simhash.simhash_groups(table, shard_size=shard_size).collect()]
    assert sorted(got, key=repr) == want


def test_simhash_in_parts(monkeypatch):
    whole = simhash.fingerprint(LONG + MAIL)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 1000)
    assert simhash.fingerprint(LONG + MAIL) == whole == slow_print(LONG + MAIL)


def test_simhash_on_odd_rows(odd, empty):
    rows = simhash.simhash_groups(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.fp, r.component_id) for r in rows if r.doc_id in (0, 1, 2)} == {(0, 0)}
    assert simhash.simhash_groups(empty).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(250, 7), (5, 5), (-3, 200)]
    out = dict(map(tuple, common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert out == {**dict.fromkeys(range(100, 141), 100), **dict.fromkeys([-3, 7, *range(200, 260)], -3)}


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, docs):
    frame, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = common.stored(stage(spark, frame, SF), name)
        assert frame.columns == docs.columns
        assert frame.filter("n_chars <> length(text)").isEmpty()
        sizes.append(frame.count())
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert sizes[0] >= docs.count() - labels.filter("toxic = 1").count() - 5
    assert sizes[0] == sizes[1] >= sizes[2] == sizes[3] > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
    check_packing(pieces, frame, 4096)


def test_near_copies_leave_one_of_each_group(spark, odd):
    rows = odd.select("doc_id", "text", "lang", "source", "n_chars", "own", "nth")
    out = corpus_pipeline.drop_near_copies(spark, rows, SF)
    assert out.columns == rows.columns
    groups = simhash.simhash_groups(rows.select(F.coalesce("doc_id", F.xxhash64("text")).alias("doc_id"), "text"))
    assert out.count() == groups.select("component_id").distinct().count()


def test_pipeline_of_nothing(spark, empty):
    frame = empty
    for name, stage in corpus_pipeline.STAGES:
        frame = common.stored(stage(spark, frame, SF), name)
    assert frame.collect() == []
