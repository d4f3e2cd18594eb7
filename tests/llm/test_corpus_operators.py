"""Every operator on a small corpus of awkward cases, against brute force."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import corpus
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillflow.llm import (
    components, embedding_dedup, exact_dedup, language_id, mixing, ngram_join, quality, sentencepiece_codec, sharding,
    token_counts, token_output,
)

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.frame(spark)


def strange_texts(seed: int, count: int) -> list[str]:
    pick = random.Random(seed)
    signs = "abcdeintrs  ▁.,éßÉΣ日本\n'''rvlmst-0123THE!?"
    return ["".join(pick.choice(signs) for _ in range(pick.randint(0, 200))) for _ in range(count)]


# --- 1 -----------------------------------------------------------------------


def test_pieces_are_the_librarys(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for row in sentencepiece_codec.encode_decode(docs, PIECES).join(docs.select("doc_id", "text").distinct(), F.col("key").eqNullSafe(F.col("doc_id"))).collect():
        if row.key in (7, None):
            continue  # two texts under one id
        assert list(row.ids) == library.encode(row.text or "")
        assert row.decoded == library.decode(list(row.ids))
    assert sentencepiece_codec.round_trip(docs, PIECES).count() == len(corpus.rows())
    assert sentencepiece_codec.encode_decode(corpus.empty(spark), PIECES).isEmpty()


def test_pieces_of_strange_texts_and_ids():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentencepiece_codec.Codec(PIECES)
    texts = [*strange_texts(1, 1500), " " * 50 + "x", "▁▁a", "a" * 3000, "\x00a\x00", "<s></s><0x41>"]
    for text in texts:
        ids = own.encode(text)
        assert ids == library.encode(text) and own.decode(ids) == library.decode(ids), text
    pick = random.Random(2)
    for _ in range(500):
        ids = [pick.randrange(0, 32_000 if pick.random() < 0.6 else 300) for _ in range(20)]
        assert own.decode(ids) == library.decode(ids)


def test_ids_are_added_beside_all_columns(spark, docs):
    out = sentencepiece_codec.with_ids(docs, PIECES)
    assert out.columns == [*[c for c in docs.columns if c != "ids"], "ids"] and out.count() == docs.count()
    assert out.filter("text IS NULL").count() == docs.filter("text IS NULL").count()


# --- 2 -----------------------------------------------------------------------


def check_exact(found, rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1] or ""].append(row[0])
    expected = Counter()
    for text, keys in groups.items():
        known = [k for k in keys if k is not None]
        keep = max(known) if known else None
        digest, kept = hashlib.sha256(text.encode()).hexdigest(), False
        for k in keys:
            first = k == keep and not kept
            kept |= first
            expected[k, digest, keep, len(keys), first] += 1
    assert Counter(tuple(r) for r in found.select("key", "digest", "keep_id", "group_size", "kept").collect()) == expected


def test_exact_dedup(spark, docs):
    check_exact(exact_dedup.exact_dedup(docs), corpus.rows())
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({r[1] or "" for r in corpus.rows()})
    assert exact_dedup.exact_dedup(corpus.empty(spark)).isEmpty() and exact_dedup.keep_one(corpus.empty(spark)).isEmpty()


@pytest.mark.parametrize("heavy", [0, 3])
def test_exact_dedup_with_and_without_heavy_hitters(spark, monkeypatch, heavy):
    """A third of the rows hold one text, a hundred of them under one id; results do not depend on who is heavy."""
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 400}", "en", "s", 1) for i in range(3000)] + [(9999, "hot", "en", "s", 1)] * 100
    if not heavy:
        none = spark.createDataFrame([], "digest string, keep long, size long, ties long")
        monkeypatch.setattr(exact_dedup, "heavy_winners", lambda slim: none)
    check_exact(exact_dedup.exact_dedup(corpus.frame(spark, rows)), rows)


# --- 3 -----------------------------------------------------------------------


def brute_kneser_ney(texts, scored):
    """Interpolated modified Kneser-Ney by its definition, over dictionaries."""
    counts = [Counter(g for found, _ in quality.grams(texts) for g in found.tolist())]
    for order in range(quality.ORDER - 1, 0, -1):
        counts.append(Counter(g % quality.SIGNS**order for g in counts[-1]))
    counts.reverse()
    prepared = []
    for level in counts:
        n = Counter(level.values())
        if n[1] and n[2] and n[3]:
            y = n[1] / (n[1] + 2 * n[2])
            d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
            d = [min(max(x, 0.1), k - 0.05) for k, x in zip((1, 2, 3), d)]
        else:
            d = [0.5, 0.75, 0.9]
        total, left = Counter(), Counter()
        for g, c in level.items():
            total[g // quality.SIGNS] += c
            left[g // quality.SIGNS] += d[min(c, 3) - 1]
        prepared.append((level, d, total, left))

    def p(g, order):
        if not order:
            return 1 / quality.SIGNS
        level, d, total, left = prepared[order - 1]
        lower, h, c = p(g % quality.SIGNS ** (order - 1), order - 1), g // quality.SIGNS, level.get(g, 0)
        return (max(0.0, c - d[min(c, 3) - 1] if c else 0.0) + left[h] * lower) / total[h] if h in total else lower

    for text in scored:
        found = [g for part, _ in quality.grams([text]) for g in part.tolist()]
        yield len(found), sum(np.log(p(g, quality.ORDER)) for g in found)


def test_perplexities_are_kneser_ney(spark):
    trusted = ["the cat sat on the mat. The dog, too!", "a dog and a cat sat down", "cats and dogs, 12 of them"]
    texts = [*trusted, "zzz ### ???", "", None, "The cat"]
    docs = spark.createDataFrame([(i, t, i < 3, "en") for i, t in enumerate(texts)], "key long, text string, trusted boolean, lang string")
    found = quality.scored(docs, quality.probabilities(quality.gram_counts(docs))).orderBy("key").collect()
    for row, (signs, logp) in zip(found, brute_kneser_ney(trusted, texts)):
        assert row.signs == signs and row.logp == pytest.approx(logp, rel=1e-4)


def test_signs_have_no_fixed_alphabet():
    """Capitals, digits and letters of any script are signs of their own, so n-grams do not saturate."""
    found = lambda text: [g for part, _ in quality.grams([text]) for g in part.tolist()]
    for one, other in (("ABBA", "CDDC"), ("1221", "3443"), ("привет", "ртефгд"), ("日本語", "木有請"), ("é", "í")):
        assert not {*found(one)} & {*found(other)}
    # Scrambled text of a non-Latin script, of more signs than eight classes, is n-grams that the ordered text has not.
    alphabet = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    assert len({*found("".join(alphabet))}) == 3000
    shuffled = alphabet[:]
    random.Random(3).shuffle(shuffled)
    assert len({*found("".join(alphabet))} & {*found("".join(shuffled))}) < 30


def test_scrambled_text_of_any_script_is_rejected(spark):
    pick = random.Random(5)
    vocabulary = ["".join(chr(0x430 + pick.randrange(32)) for _ in range(pick.randint(3, 8))) for _ in range(100)]
    clean = [" ".join(pick.choice(vocabulary) for _ in range(120)) for _ in range(120)]
    # Every letter is replaced by one eight further on: the same class of signs before.
    junk = ["".join(c if c == " " else chr(0x430 + (ord(c) - 0x430 + 8 * pick.randrange(1, 4)) % 32) for c in t) for t in clean[:10]]
    rows = [(i, t, "ru", "s", 1) for i, t in enumerate(clean + junk)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    found = {r.key: r.kept for r in quality.classify(corpus.frame(spark, rows), labels).collect()}
    assert not any(found[i] for i in range(120, 130)) and sum(found[i] for i in range(120)) >= 117


def test_the_limit_is_the_quantile_itself(spark):
    bits = [2 + i / 100 for i in range(100)]
    rows = [(i, True, "en", 100_000, -b * 100_000) for i, b in enumerate(bits)] + [(100, False, "en", 100_000, -3.2 * 100_000)]
    found = {r.key: r for r in quality.judged(spark.createDataFrame(rows, "key long, trusted boolean, lang string, signs long, logp double").withColumn("digest", F.lit(None).cast("binary"))).collect()}
    assert not found[100].kept and sum(found[i].kept for i in range(100)) == 99


def test_quality_rejects_junk_and_keeps_the_rest(spark, docs):
    pick = random.Random(4)
    vocabulary = ["".join(pick.choice("aeiounrst") for _ in range(pick.randint(2, 8))) for _ in range(300)]
    clean = [" ".join(pick.choice(vocabulary) for _ in range(80)) for _ in range(150)]
    junk = ["".join(pick.choice("#$%&*|QXZ0123456789 ") for _ in range(300)) for _ in range(10)]
    rows = [(i, t, "en" if i % 2 else None, "s", 1) for i, t in enumerate(clean + junk)] + [(900, None, "en", "s", 0), (901, " ", "xx", "s", 0), (None, clean[0], "en", "s", 0)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)] + [(3, 1, 0), (150, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = corpus.frame(spark, rows)
    found = {r.key: r for r in quality.classify(docs, labels).collect()}
    assert not any(found[i].kept for i in range(150, 160))
    assert sum(found[i].kept for i in range(150)) >= 148 and found[900].kept and found[901].kept and found[None].kept
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in found.values())
    assert all(r.kept for r in quality.classify(docs, labels.limit(0)).collect())
    assert quality.classify(corpus.empty(spark), labels).isEmpty()


# --- 4 -----------------------------------------------------------------------


def check_components(found, rows):
    sets = [corpus.shingle_set(r[1]) for r in rows]
    roots = corpus.classes(len(rows), corpus.shingle_links(sets))
    smallest = defaultdict(list)
    for row, root in zip(rows, roots):
        smallest[root].append(row[0])
    expected = Counter(
        (row[0], len(s), min((k for k in smallest[root] if k is not None), default=None)) for row, s, root in zip(rows, sets, roots)
    )
    assert Counter(tuple(r) for r in found.select("key", "n_shingles", "component_id").collect()) == expected


def near_copies(seed: int, groups: int) -> list[tuple]:
    """Texts of 1 to 60 words with copies that differ by a word or two, and a passage that many share."""
    pick, out = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(pick.randint(1, 60))]
        for _ in range(pick.randint(1, 6)):
            text = list(base)
            for _ in range(pick.randint(0, 2)):
                place = pick.randrange(len(text))
                text[place : place + 1] = pick.choice([[], ["new"], [text[place], "and"]]) or ["gone"]
            if pick.random() < 0.3:
                text = [*corpus.BASE[:12], *text]
            out.append(" ".join(text))
    return [(i, t, "en", "s", 1) for i, t in enumerate(out)]


def test_jaccard_components(spark, docs):
    check_components(ngram_join.jaccard_components(docs), corpus.rows())
    assert ngram_join.jaccard_components(corpus.empty(spark)).isEmpty()
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    gone = {r.key for r in ngram_join.jaccard_components(docs).filter("key <> component_id").collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r[0] for r in corpus.rows()} - gone


@pytest.mark.parametrize("most", [None, 0, 12])
def test_jaccard_components_whatever_the_boundary(spark, monkeypatch, most):
    rows = near_copies(5, 120)
    if most is not None:
        monkeypatch.setattr(ngram_join, "boundary", lambda counts: most)
    check_components(ngram_join.jaccard_components(corpus.frame(spark, rows)), rows)


def test_small_sets_link_by_their_subsets():
    for a in range(1, 40):
        for b in range(a, 50):
            least = next((i for i in range(a + 1) if 100 * i >= 80 * (a + b - i)), None)
            assert (ngram_join.need(a, b) <= a) == (least is not None) and least in (None, ngram_join.need(a, b))
            if least is not None:
                assert (a, b) in ngram_join.partners(a, 50) and (a, b) in ngram_join.partners(b, 50)


def test_cells_never_rule_out_a_link():
    pick = np.random.default_rng(3)
    for n in (1, 2, 7, 60, 900):
        base = np.unique(pick.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        other = np.unique(np.concatenate([base[: -(-len(base) * 9 // 10)], pick.integers(0, 2**63, n // 20).astype(np.uint64)]))
        shared = len(np.intersect1d(base, other))
        if shared >= ngram_join.need(len(base), len(other)):
            assert ngram_join.may_link(ngram_join.cells(base), ngram_join.cells(other), len(base), len(other))
        far = np.unique(pick.integers(0, 2**63, n).astype(np.uint64))
        assert n < 60 or not ngram_join.may_link(ngram_join.cells(base), ngram_join.cells(far), len(base), len(far))


def test_sketches_bound_what_two_sets_do_not_share():
    pick = np.random.default_rng(5)
    for n in (1, 7, 60, 300, 5000):
        base = np.unique(pick.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        for kept in (n, n * 19 // 20, n * 3 // 4, n // 3):
            other = np.unique(np.concatenate([base[:kept], pick.integers(0, 2**63, n - kept).astype(np.uint64)]))
            differ = sum(((x ^ y) % 2**64).bit_count() for x, y in zip(ngram_join.sketch(base), ngram_join.sketch(other)))
            apart = len(np.setxor1d(base, other))
            assert differ <= apart and (differ - apart) % 2 == 0
            assert kept > n // 2 or n < 60 or n > 1000 or len(base) + len(other) < 9 * differ


def test_components_of_a_chain_a_star_and_a_ring(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200 + i, 200 + (i + 1) % 30) for i in range(30)] + [(5, 5)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {i: 200 for i in range(200, 230)}


# --- 5 -----------------------------------------------------------------------


def check_shards(found, rows, shards=24):
    size = lambda t: len((t or "").encode()) + 8
    expected = Counter((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.key, r["size"], r.text_crc32) for r in found) == expected
    per = defaultdict(list)
    for r in found:
        per[r.shard].append(r)
    assert set(per) <= set(range(shards))
    assert all(sorted(r.slot for r in p) == list(range(len(p))) for p in per.values())
    return {s: sum(r["size"] for r in p) for s, p in per.items()}


def test_shards(spark, docs):
    check_shards(sharding.assign_shards(docs).collect(), corpus.rows())
    assert sharding.assign_shards(corpus.empty(spark)).isEmpty()
    again = [{tuple(r) for r in sharding.assign_shards(docs).collect()} for _ in range(2)]
    assert {r[:4] for r in again[0]} == {r[:4] for r in again[1]}


def test_shards_are_even_though_a_third_are_copies(spark):
    rows = [(i, "hot " * 50 if i % 3 == 0 else f"{i} " * (i % 90), "en", "s", 1) for i in range(6000)]
    found = sharding.assign_shards(corpus.frame(spark, rows)).collect()
    per = check_shards(found, rows)
    mean = sum(per.values()) / 24
    assert len(per) == 24 and max(per.values()) < 1.02 * mean and min(per.values()) > 0.98 * mean


def test_written_shards_hold_every_row(spark, docs, root):
    sharding.write_shards(docs, f"{root}/shards", shards=4)
    back = spark.read.parquet(f"{root}/shards")
    assert back.count() == docs.count() and back.select("row.*").columns == docs.columns


# --- 6 -----------------------------------------------------------------------


def test_token_counts_are_the_librarys(spark, docs):
    library = Tokenizer.from_file(WORDS)
    expected = Counter((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in corpus.rows())
    assert Counter(tuple(r) for r in token_counts.token_counts(docs, WORDS).collect()) == expected
    assert token_counts.token_counts(corpus.empty(spark), WORDS).isEmpty()


def test_token_counts_of_strange_texts_in_chunks():
    library, own = Tokenizer.from_file(WORDS), token_counts.Transducer(WORDS)
    texts = [*strange_texts(6, 1500), "it's we're they'll I'd 'tis ''s '' 'r 'l 're're don't!'s x'l y'v 'v", "<|endoftext|>abc<|STARTOFTEXT|>", "ΣΟΦΟΣ İ ﬁ½²Ⅷ", "x" * 2000]
    for text in texts:
        expected = len(library.encode(text, add_special_tokens=False).ids)
        assert own.count(text) == own.count(text, chunk_signs=7) == expected, text


def test_chunk_maps_compose_in_any_grouping():
    own = token_counts.Transducer(WORDS)
    maps = [own.chunk_map(c) for c in ("one tw", "o", " thr", "ee four f", "", "ive")]
    left = maps[0]
    for m in maps[1:]:
        left = own.composed(left, m)
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = own.composed(m, right)
    assert left == right == own.folded(maps) and own.total(left) == own.count("one two three four five")


def test_texts_without_blanks_hold_no_prefixes():
    own, text = token_counts.Transducer(WORDS), "ab1cd/" * 40_000
    whole = own.count(text)
    tracemalloc.start()
    assert own.count(text, chunk_signs=256) == whole
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(text)  # all prefixes of the chunks are some 470 times the text


# --- 7 -----------------------------------------------------------------------


def targets(sizes: dict) -> dict:
    """Targets by source: shared by weight 1, 2, 3, repeating; capped at three times the size; the excess shared again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = [s for s in order if s not in capped]
        share = (total - sum(3 * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in left))
        over = {s for s in left if weight[s] * share > 3 * sizes[s]}
        if not over:
            return {s: float(3 * sizes[s]) if s in capped else weight[s] * share for s in order}
        capped |= over


def check_mix(documents, rows):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(corpus.words(r[1]))
    wanted = targets(sizes)
    taken = Counter()
    order = {s: i for i, s in enumerate(sorted(s for s in sizes if s is not None))} | ({None: len([s for s in sizes if s is not None])} if None in sizes else {})
    for r in documents:
        source = next(s for s, i in order.items() if i == r.source_no)
        assert r.source_size == sizes[source] and r.target == pytest.approx(wanted[source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source] += r.taken
    assert Counter((r.key, r["size"]) for r in documents) == Counter((r[0], len(corpus.words(r[1]))) for r in rows)
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 1


def test_mix(spark, docs):
    found = mixing.mix(docs)
    first = found.documents.collect()
    check_mix(first, corpus.rows())
    assert Counter(map(tuple, first)) == Counter(map(tuple, mixing.mix(docs).documents.collect()))
    assert found.shard_counts().agg(F.sum("count")).first()[0] == found.slots.count()
    assert mixing.mix(corpus.empty(spark)).documents.isEmpty() and mixing.repeated(corpus.empty(spark)).isEmpty()
    again = mixing.repeated(docs)
    assert again.columns == docs.columns and again.filter("doc_id IS NULL").count() == 2


def test_equal_rows_without_words_stay_rows(spark):
    rows = [(None, None, "en", "s1", 0)] * 4 + [(None, "", "en", None, 0)] * 3 + [(7, "  ", "en", "s1", 2)] * 2 + [(8, "two words", "en", "s1", 9)] * 2
    check_mix(mixing.mix(corpus.frame(spark, rows)).documents.collect(), rows)


def test_mix_with_a_hot_source_and_capped_ones(spark):
    rows = [(i, f"w{i} " * (i % 700), "en", "hot" if i % 3 else f"s{i % 11}", 1) for i in range(900)] + [(i, "few words", "en", f"tiny{i % 5}", 1) for i in range(900, 920)]
    found = mixing.mix(corpus.frame(spark, rows), block_words=16, out_shards=8)
    check_mix(found.documents.collect(), rows)
    per = [r.n for r in found.slots.groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert len(per) == 8 and max(per) - min(per) <= 8
    copies = mixing.repeated(corpus.frame(spark, rows))
    words = lambda frame: frame.agg(F.sum(mixing.word_count("text"))).first()[0]
    assert words(copies) == pytest.approx(sum(len(corpus.words(r[1])) for r in rows), rel=0.1)


def test_copies_keep_the_target_of_each_source(spark):
    pick = random.Random(7)
    rows = [(i, "w " * (3000 if i % 40 == 0 else pick.randint(1, 60)), "en", f"s{i % 7}", 1) for i in range(700)] + [(i, "w " * 2000, "en", "few", 1) for i in range(700, 703)]
    wanted = {r.source: r.target for r in mixing.mix(corpus.frame(spark, rows)).sources.collect()}
    taken, most = Counter(), Counter()
    for r in mixing.repeated(corpus.frame(spark, rows)).collect():
        taken[r.source] += len(corpus.words(r.text))
    for r in rows:
        most[r[3]] = max(most[r[3]], len(corpus.words(r[1])))
    assert all(abs(taken[s] - t) <= most[s] + 1 for s, t in wanted.items())


@pytest.mark.parametrize("size", [1, 2, 7, 100, 1000])
def test_slots_are_permuted(spark, size):
    numbers = spark.range(size).select(mixing.permuted(F.col("id"), F.lit(size), F.lit(3)).alias("x"))
    assert sorted(r.x for r in numbers.collect()) == list(range(size))


# --- 8 -----------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 3, 10, 1000, 4097])
def test_training_order_is_a_permutation(size):
    slots = token_output.slots_of(np.arange(size), size)
    assert sorted(slots) == list(range(size))
    assert (token_output.numbers_of(slots, size) == np.arange(size)).all()


def test_token_files_hold_every_text(spark, docs, root):
    from pathlib import Path

    length = 64
    found = token_output.write(docs, f"{root}/out", BYTES, public_tokenizers.PATTERN, length=length, shard_sequences=50).collect()
    own = token_output.encoder(BYTES, public_tokenizers.PATTERN)
    shards = [list(Path(root, "out", f"shard={s}").glob("part-*")) for s in range(-(-len(found) // 50))]
    assert all(len(files) == 1 for files in shards)
    stored = np.concatenate([np.fromfile(files[0], "<u2").reshape(-1, length) for files in shards])
    assert sorted(r.slot for r in found) == list(range(len(found))) == list(range(len(stored)))
    for r in found:
        assert r.shard == r.slot // 50 and r.byte_offset == r.slot % 50 * 2 * length
        assert zlib.crc32(stored[r.slot, :-1].tobytes()) == r.ids_crc32
    assert (stored[:, -1] == own.end).all()
    ids = stored[token_output.slots_of(np.arange(len(found)), len(found))][:, :-1].ravel().tolist()
    texts, text = Counter(), []
    for i in ids:
        if i == own.end:
            texts[own.library.decode(text)] += 1
            text = []
        else:
            text.append(i)
    texts[""] = Counter(r[1] or "" for r in corpus.rows())[""]  # padding looks like empty texts
    assert texts == Counter(r[1] or "" for r in corpus.rows())
    assert {k for r in found for k in r.doc_ids} == {r[0] for r in corpus.rows()}
    assert token_output.write(corpus.empty(spark), f"{root}/none", BYTES, public_tokenizers.PATTERN).isEmpty()


# --- 9 -----------------------------------------------------------------------


def test_language_bundles_are_sums_of_bound_trigrams():
    own = language_id.Space(64)
    signs = own.signs("Ab, cé!")
    assert "".join(map(chr, signs)) == " ab cé "
    expected = sum(own.bound(tuple(signs[i : i + 3].tolist())).astype(int) for i in range(len(signs) - 2))
    twice = own.bundles([signs, own.signs("12 !"), signs], np.arange(3), 3)
    assert (twice[0] == expected).all() and (twice[1] == 0).all() and (twice[2] == expected).all()


def test_languages_are_told_apart(spark, docs, monkeypatch):
    pick = random.Random(8)
    letters = {"aa": "abcdefgh", "bb": "abijklmn", "cc": "éßabqrst"}
    rows = []
    for i in range(300):
        lang = pick.choice(list(letters))
        text = " ".join("".join(pick.choice(letters[lang]) for _ in range(pick.randint(2, 7))) for _ in range(40))
        rows.append((i, text, lang, "s", 1))
    rows += [(1000, None, "aa", "s", 0), (1001, "12 ?!", "bb", "s", 0), (None, rows[0][1], "aa", "s", 0), (1002, rows[1][1], None, "s", 0)]
    monkeypatch.setattr(language_id, "SLICE_SIGNS", 100)  # texts are cut into pieces
    frame = corpus.frame(spark, rows)
    found = language_id.identify(frame).collect()
    truth = {r[0]: r[2] for r in rows}
    assert all(r.held_out == (r.key is None or zlib.crc32(str(r.key).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 for r in found) and len(found) == len(rows)
    right = [r.lang_pred == truth[r.key] for r in found if r.key is not None and r.key < 1000]
    assert sum(right) >= 0.99 * len(right)
    assert {r.lang_pred for r in found if r.key in (1000, 1001)} == {"und"}
    assert {r.lang_pred for r in language_id.identify(frame.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(corpus.empty(spark)).isEmpty()


# --- 10 ----------------------------------------------------------------------


def vectors(seed: int) -> list[tuple]:
    """Clusters of near vectors, exact copies, scaled copies and vectors that cannot link."""
    pick = np.random.default_rng(seed)
    out = []
    for _ in range(60):
        centre = pick.standard_normal(24)
        for _ in range(pick.integers(1, 9)):
            out.append((centre + pick.standard_normal(24) * pick.choice([0.0, 0.05, 0.15, 0.22])).astype(np.float32).tolist())
    out += [out[0]] * 40 + [[2 * x for x in out[1]]]
    odd = [None, [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [], [1.0], [1.0], [2.0, 0.0]]
    return [(i, v, i % 3) for i, v in enumerate(out + odd)]


@pytest.mark.parametrize("block", [256, 8])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors(9)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({n: F.lit("clash") for n in ("key", "vector", "cls", "n", "h1")})
    found = {r.key: r for r in embedding_dedup.near_duplicates(frame).collect()}
    usable = [(i, np.array(v, float)) for i, v, _ in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = []
    for x in range(len(usable)):
        for y in range(x):
            (i, a), (j, b) = usable[x], usable[y]
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                links.append((i, j))
    degree = Counter(i for pair in links for i in pair)
    roots = corpus.classes(len(rows), links)
    missed = sum(found[i].n_links != degree[i] for i, _, _ in rows)
    assert all(found[i].n_links <= degree[i] for i, _, _ in rows) and missed <= 0.01 * len(rows)
    if not missed:
        assert [found[i].component_id for i, _, _ in rows] == roots
    assert all(r.kept == (r.key == r.component_id) for r in found.values())
    assert embedding_dedup.near_duplicates(frame.limit(0)).isEmpty()


def test_repeated_vector_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (None, [1.0, 0.0]), (3, [1.0, 0.01])]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert Counter((r.key, r.n_links, r.component_id) for r in found.collect()) == Counter(
        [(1, 2, 1), (1, 1, 1), (2, 1, 1), (None, 2, 1), (3, 2, 1)])


def test_rows_go_by_key_and_text(spark):
    """Rows without a key and keys with two texts: what links or is rejected goes, its namesakes stay."""
    base = corpus.BASE * 3
    near = [" ".join([*base, *[f"x{i}"]]) for i in range(4)]
    rows = [(5, near[0]), (None, near[1]), (7, "a text of its own"), (7, near[2]), (None, "another one"), (3, near[3]), (3, near[3]), (None, None)]
    docs = corpus.frame(spark, [(k, t, "en", "s", 0) for k, t in rows])
    kept = Counter((r.doc_id, r.text) for r in ngram_join.keep_first(docs).collect())
    assert kept == Counter([(7, "a text of its own"), (None, "another one"), (3, near[3]), (3, near[3]), (None, None)])
    pick = random.Random(3)
    clean = [" ".join(pick.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60)) for _ in range(100)]
    junk = "#$%&*|QXZ0987 " * 30
    rows = [*enumerate(clean), (None, junk), (4, junk), (None, clean[0])]
    docs = corpus.frame(spark, [(k, t, "en", "s", 0) for k, t in rows])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10, 100)], "doc_id long, quality int, toxic int")
    kept = {(r.doc_id, r.text) for r in quality.keep_good(docs, labels).collect()}
    assert not kept & {(None, junk), (4, junk)} and {(4, clean[4]), (None, clean[0])} <= kept


def test_states_are_forgotten_inside_a_word(monkeypatch):
    """Random letters without a blank keep finding new states; counts stay the library's."""
    from tillflow.llm import token_counts as module

    monkeypatch.setattr(module, "STATES_KEPT", 500)
    own, library, pick = module.Transducer(WORDS), Tokenizer.from_file(WORDS), random.Random(8)
    for length in (30_000, 3_000, 200):
        text = "".join(pick.choice("abcdefghijklmnopqrstuvwxyzé日") for _ in range(length))
        assert own.count(text, 1024) == len(library.encode(text, add_special_tokens=False).ids)
        assert len(own.words.states) <= 500


def test_bundles_of_large_alphabets_stay_small():
    """300 texts of 300 signs out of 20,000 letters: as plain sums give it, in bounded memory."""
    pick = np.random.default_rng(9)
    texts = ["".join(map(chr, pick.integers(0x4E00, 0x9E00, 300))) for _ in range(300)]
    own = language_id.Space(64)
    signs = [own.signs(t) for t in texts]
    tracemalloc.start()
    found = own.bundles(signs, np.arange(300), 300)
    assert tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()
    for i in (0, 150, 299):
        plain = sum(own.bound(tuple(g)).astype(int) for g in zip(*(signs[i][k : len(signs[i]) - 2 + k].tolist() for k in range(3))))
        assert found[i].tolist() == plain.tolist()
    few = own.bundles(signs[:5] * 2, np.array([0, 1, 0, 1, 0] * 2), 2)
    assert few[0].tolist() == (2 * (found[0] + found[2] + found[4])).tolist()


def test_workers_keep_no_memos_between_tasks(spark, docs):
    """Workers live on, and what one holds is missing to the stages that follow on its executor."""
    assert sentencepiece_codec.with_ids(docs, PIECES).count() == len(corpus.rows())

    def held(batches):
        for _ in batches:
            memos = [m for c in sentencepiece_codec._codecs.values() for m in (c.known, c.older, c.follows)]
            yield pa.RecordBatch.from_pydict({"n": [sum(map(len, memos))]}, pa.schema([("n", pa.int64())]))

    found = spark.range(64, numPartitions=64).mapInArrow(held, "n long").collect()
    assert [row["n"] for row in found] == [0] * 64


def test_frequent_digests_are_made_without_python_workers(spark):
    """Rows that Spark parallelizes from Python objects are unpacked by workers of a second daemon."""
    docs = spark.createDataFrame([(i, "the same text") for i in range(50)], "doc_id long, text string")
    for texts, frequent in ((docs, 1), (docs.limit(1), 0)):
        winners = exact_dedup.heavy_winners(exact_dedup.digests(texts, "doc_id", "text"))
        assert winners.count() == frequent
        assert "RDD" not in winners._jdf.queryExecution().optimizedPlan().toString()
