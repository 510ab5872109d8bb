"""Near-duplicates, repeated substrings, leaks and packing against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from sluicegate.llm import anchors, decontaminate, induced, packing, queries, simhash, substrings, suffixes
from tests.llm.test_text_statistics import same_rows
from tests.llm.texts import corpus, frame, prose, save


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return save(spark, tmp_path_factory.mktemp("dups"), documents=frame(spark, corpus()), benchmark=items(spark))


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    return save(
        spark, tmp_path_factory.mktemp("none"), documents=frame(spark, []), benchmark=items(spark)
    )


def items(spark):
    rows = [(1, "the quick stone walks by night over a plain river of words and never comes back home"), (2, None), (3, ""), (4, "...")]
    return spark.createDataFrame(rows, "item_id long, text string")


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, f"{p:016x}", least.get(find(i))) for i, ((key, _), p) in enumerate(zip(rows, prints, strict=True))]


def test_simhash_components(spark, folder):
    same_rows(queries.op8_simhash(spark, folder), plain_components(corpus()))


def test_vantage_point_shards_lose_no_link():
    random_ = np.random.default_rng(3)
    centres = random_.integers(0, 2**63, 60, dtype=np.uint64)
    flips = np.uint64(1) << random_.integers(0, 64, 3000, dtype=np.uint64)
    points = np.unique(np.concatenate([centres, centres[random_.integers(0, 60, 3000)] ^ flips, random_.integers(0, 2**63, 500, dtype=np.uint64)]))
    router = simhash.Router(points[:200], 4, 2)
    shard, who, own = router.route(points)
    assert sorted(who[own].tolist()) == list(range(len(points)))
    parent = np.arange(len(points))
    for s in range(router.shards):
        mine = shard == s
        found = simhash.forest(points[who[mine]], own[mine], 2)
        parent = simhash._unite(parent, who[mine], who[mine][found])
    close = np.bitwise_count(points[:, None] ^ points[None, :]) <= 2
    expected = simhash._unite(np.arange(len(points)), *np.nonzero(close))
    assert (simhash._roots(parent) == simhash._roots(expected)).all()


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    found = {r.v: r.root for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 60)}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_dedup_stage_keeps_one_of_each_component(spark):
    """Components of fingerprints of 3-word shingles, 2 bits or fewer apart, by brute force."""
    r = random.Random(21)
    rows = [(i, prose(r, r.randint(50, 200))) for i in range(20)]
    for i, text in rows[:20]:
        for k in range(1, 7):
            words = text.split()
            if k > 2:
                words[r.randrange(len(words))] = f"edit{r.randrange(10**6)}"
            rows.append((100 * k + i, " ".join(words).upper() if k == 2 else " ".join(words)))
    rows += [(5000, ""), (5001, None), (5002, "a b"), (5003, "A  b"), (None, rows[3][1]), rows[4]]
    least = {i for i, _, c in plain_components(rows) if i == c}
    assert 20 < len(least) < len(rows) - 30
    kept = corpus_pipeline.simhash_near_dedup(spark, frame(spark, rows), "")
    assert {x.doc_id for x in kept.collect()} - {None} == least - {None}


def plain_windows(rows, window):
    """Kept words; null ids first, rows equal in id and text are one document."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, np.int64(np.uint64(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)))))
    seen, kept = set(), {}
    for row in order:
        words = (row[1] or "").encode().split()
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if key in seen:
                gone[at : at + window] = [True] * window
            seen.add(key)
        left = [w for w, g in zip(words, gone, strict=True) if not g]
        kept[row] = (row[0], len(words), sum(gone), hashlib.sha256(b" ".join(left)).hexdigest())
    return [kept[row] for row in rows]


def test_substring_windows(spark, folder):
    same_rows(queries.op2_substrings(spark, folder), plain_windows(corpus(), 20))


def test_first_places_of_salted_groups_are_compared(spark):
    firsts = spark.range(0, 200, 1, 4).selectExpr(
        "if(id = 7, null, id) AS id", "1L AS tie", "array(3) AS begins", "array(23) AS ends", "id % 5 AS key", "9L AS full"
    )
    later = {r.id for r in substrings._later_of_firsts(firsts).collect()}
    assert later == set(range(200)) - {0, 1, 3, 4, 7}  # a null id comes first


@pytest.mark.parametrize("frequent", [0, 2, 5])
def test_frequent_windows_go_another_way_to_the_same_result(spark, frequent):
    passage = prose(random.Random(2), 40)
    rows = [*corpus(), *((500 + i, f"{prose(random.Random(i), 9)} {passage} {i}") for i in range(12))]
    found = substrings.deduplicate(frame(spark, rows), frequent=frequent)
    plain = [(i, n, gone) for i, n, gone, _ in plain_windows(rows, 20)]
    same_rows(found.select("doc_id", "n_words", "n_removed"), plain)


def test_many_equal_rows_carry_each_place_once(spark):
    text = prose(random.Random(3), 200)
    rows = [(1, text)] * 60 + [(2, text)]
    same_rows(substrings.deduplicate(frame(spark, rows)).select("doc_id", "n_removed"), [(1, 0)] * 60 + [(2, 200)])
    texts = anchors.keyed(frame(spark, rows), "doc_id", "text")
    for spans in (substrings.repeated_windows(texts, 20), substrings.repeated_windows(texts, 20, 0)):
        carried = spans.selectExpr("sum(size(flatten(begins)))").first()[0]
        assert carried < 400


@pytest.mark.parametrize("window", [4, 8])
def test_short_windows_with_few_words(spark, window):
    r = random.Random(window)
    rows = [(i % 9, " ".join(r.choice("ab") for _ in range(r.randint(0, 30)))) for i in range(30)]
    found = substrings.deduplicate(frame(spark, rows), window=window)
    plain = [(i, n, gone) for i, n, gone, _ in plain_windows(rows, window)]
    same_rows(found.select("doc_id", "n_words", "n_removed"), plain)


def plain_strings(rows, length):
    texts = {row: (row[1] or "").encode() for row in rows}
    starts = Counter(t[i : i + length] for t in texts.values() for i in range(len(t) - length + 1))
    found = []
    for row in rows:
        text = texts[row]
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            if starts[text[at : at + length]] > 1:
                gone[at : at + length] = b"\1" * length
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        found.append((row[0], len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def test_repeated_strings(spark, folder):
    same_rows(queries.op4_suffixes(spark, folder), plain_strings(corpus(), 200))


def test_repeated_strings_of_two_letters_in_small_shards(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 100)
    r = random.Random(2)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randint(0, 20))) * r.randint(1, 12)) for i in range(40)]
    found = suffixes.deduplicate(frame(spark, rows), length=40)
    same_rows(
        found.select("doc_id", "n_bytes", "n_removed", "n_spans"), [row[:4] for row in plain_strings(rows, 40)]
    )


@pytest.mark.parametrize("trial", range(60))
def test_induced_suffix_order(monkeypatch, trial):
    """Order and prefixes are right when ranges spill, arrays are files, and names recurse."""
    random_ = np.random.default_rng(trial)
    monkeypatch.setattr(induced, "RANGE_TUPLES", int(random_.choice([3, 20, 8192])))
    text = random_.integers(1, 1 + random_.choice([1, 2, 3, 10, 200]), random_.integers(5, 250))
    if trial % 3 == 0:
        text = np.concatenate([text, text, text[: len(text) // 2]])
    text = np.append(text, 0).astype(np.uint32)
    cap = int(random_.choice([5, 200]))
    arena = induced.Arena(int(random_.choice([5, 10**6])), int(random_.choice([100, 10**8])))
    with arena:
        order, shared = induced.suffix_order(text, cap, arena, int(random_.choice([1, 10**6])))
        order, shared = np.array(order).tolist(), np.array(shared).tolist()
    suffixes_ = [tuple(text[i:].tolist()) for i in range(len(text))]
    expected = sorted(range(len(text)), key=suffixes_.__getitem__)
    assert order == expected
    for at in range(1, len(order)):
        pair = zip(suffixes_[order[at - 1]], suffixes_[order[at]], strict=False)
        same = next((k for k, (x, y) in enumerate(pair) if x != y), 0)
        assert shared[at] == min(same, cap)
    assert arena._folder is None or not arena._folder.exists()


def words_of(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def plain_distance(item, words):
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        last, row = row, [i]
        for j, y in enumerate(words, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return min(row)


def test_leaks_match_exact_alignment(spark):
    r = random.Random(9)
    texts = [prose(r, n) for n in (5, 6, 9, 15, 20, 41, 60)]
    bench = [(i, t) for i, t in enumerate(texts)] + [(90, None), (91, ""), (92, "?!")]
    rows = []
    for n, text in enumerate(texts):
        for edits in range(0, 16):
            words = text.split()
            for _ in range(edits):
                at = r.randrange(len(words))
                change = r.randrange(3)
                words[at : at + (change != 1)] = [] if change == 0 else [f"new{r.randrange(99)}"]
                words = words or ["x"]
            rows.append((100 * n + edits, f"{prose(r, 30)} {' '.join(words)} {prose(r, 30)}"))
    rows += corpus()
    docs = frame(spark, rows)
    table = spark.createDataFrame(bench, "item_id long, text string")
    found = {(x.doc_id, x.item_id): x.similarity for x in decontaminate.find_leaks(docs, table).collect()}
    expected = {}
    for key, text in rows:
        for item, other in bench:
            wanted = words_of(other)
            if wanted:
                distance = plain_distance(wanted, words_of(text))
                if distance <= decontaminate.edits_allowed(len(wanted), 0.8):
                    expected[key, item] = 1 - distance / len(wanted)
    assert set(found) <= set(expected)
    assert len(found) >= 0.97 * len(expected) and all(k in found for k, v in expected.items() if v == 1)
    assert all(abs(found[k] - expected[k]) < 1e-9 for k in found)


def test_tables_meet_edited_windows_and_few_others():
    """Pieces at the distance bound are met in nine of ten cases or more, unrelated windows in under one of twenty."""
    random_ = np.random.default_rng(2)
    for size in (8, 10, 20, 32):
        pieces = random_.integers(1, 1 << 60, (300, size)).astype(np.uint64)
        block = decontaminate.Items(list(range(300)), list(pieces), 0.8, decontaminate.RECALL)
        edited = np.zeros((300, decontaminate.PIECE_WORDS), np.uint64)
        for at, piece in enumerate(pieces):
            words = piece.tolist()
            for _ in range(decontaminate.edits_allowed(size, 0.8)):
                place = random_.integers(len(words))
                words[place : place + 1] = [[], [7], [words[place], 7]][random_.integers(3)]
            edited[at, : len(words[:size])] = words[:size]
        window, piece = block.met(edited, np.full(300, size))
        assert (window == piece).sum() >= 0.93 * 300
        other = np.zeros((3000, decontaminate.PIECE_WORDS), np.uint64)
        other[:, :size] = random_.integers(1, 1 << 60, (3000, size))
        assert len(block.met(other, np.full(3000, size))[0]) < 0.05 * 3000


def test_edits_may_gather_in_a_long_item(spark):
    r = random.Random(31)
    word = lambda: f"{r.choice('abcdefgh')}{r.randrange(5000)}"
    table, docs = [], []
    for key in range(20):
        words = [word() for _ in range(1000)]
        table.append((key, " ".join(words)))
        low = r.choice((0, 400, 744))
        for at in r.sample(range(low, low + 256), 180):
            words[at] = "other"
        docs.append((key, " ".join([*(word() for _ in range(30)), *words, *(word() for _ in range(30))])))
    found = decontaminate.find_leaks(frame(spark, docs), spark.createDataFrame(table, "item_id long, text string")).collect()
    assert {(x.doc_id, x.item_id) for x in found} == {(key, key) for key in range(20)}
    # Words edited at an end may be left out of the stretch at the same distance.
    assert all(abs(x.similarity - 0.82) < 1e-9 and 30 <= x.first_word and x.first_word + x.n_words <= 1030 for x in found)


def test_every_stretch_of_an_item_is_reported(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, f"a b {item} c d {item} {item.replace('three', 'x')} e"), (2, f"é {item}")]
    found = decontaminate.find_leaks(frame(spark, docs), spark.createDataFrame([(5, item)], "item_id long, text string"))
    rows = sorted((x.doc_id, x.first_word, x.n_words, round(x.similarity, 3), x.start, x.stop) for x in found.collect())
    size = len(item)
    assert rows == [
        (1, 2, 10, 1.0, 4, 4 + size), (1, 14, 10, 1.0, 9 + size, 9 + 2 * size),
        (1, 24, 10, 0.9, 10 + 2 * size, 6 + 3 * size), (2, 1, 10, 1.0, 3, 3 + size),
    ]


def test_leaks_of_awkward_tables(spark, folder, nothing):
    assert queries.op3_decontaminate(spark, folder).count() == 0
    assert queries.op3_decontaminate(spark, nothing).count() == 0
    leaky = frame(spark, [(1, items(spark).first().text.upper()), (None, "x " + items(spark).first().text), (1, None)])
    found = decontaminate.find_leaks(leaky, items(spark), block_items=2)
    assert sorted((x.doc_id or -1, x.item_id, x.first_word, x.similarity) for x in found.collect()) == [(-1, 1, 1, 1.0), (1, 1, 0, 1.0)]
    assert decontaminate.find_leaks(leaky, items(spark).limit(0)).count() == 0


def check_packing(rows, docs, length, end_id=1):
    """Round trip: the pieces are the documents' ids, and sequences have no gaps."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    expected = Counter()
    for key, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        for piece, low in enumerate(range(0, len(ids), length)):
            part = ids[low : low + length]
            expected[key, piece, low, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, size in sorted(placed):
            assert offset == end
            end += size
        assert end <= length
    return len(sequences)


def test_packing_round_trip(spark, folder, nothing):
    rows = queries.op10_packing(spark, folder).collect()
    used = check_packing(rows, corpus(), 4096)
    assert used <= -(-sum(r.length for r in rows) // 4096) + 2
    assert queries.op10_packing(spark, nothing).count() == 0


def test_packing_short_sequences(spark):
    r = random.Random(4)
    docs = [(i, prose(r, r.randint(0, 40))) for i in range(120)]
    path = public_tokenizers.path(queries.TOKENIZER)
    rows = packing.pack(frame(spark, docs), path, length=64, end_id=7).collect()
    used = check_packing(rows, docs, 64, 7)
    full = sum(x.length == 64 for x in rows)
    rest = np.bincount([x.length for x in rows if x.length < 64], minlength=65)
    assert used <= full + sum(many for _, many in packing.best_fit(rest, 64)) + 1


def test_configurations_hold_every_piece():
    random_ = np.random.default_rng(0)
    for top in (10, 100):
        counts = np.append(0, random_.integers(0, 50, top))
        plan = packing.configurations(counts, top)
        held = sum(np.bincount(sizes, minlength=top + 1) * many for sizes, many in plan)
        assert (held == counts).all() and all(sum(sizes) <= top for sizes, _ in plan)
        used, bound = sum(many for _, many in plan), (counts * np.arange(top + 1)).sum() / top
        assert used <= 1.12 * bound + 2
    assert packing.configurations(np.zeros(11, int), 10) == []


def test_the_linear_program_places_most_pieces():
    random_ = np.random.default_rng(5)
    for n in (8_000, 200_000):
        lengths = np.clip(random_.lognormal(6.3, 0.9, n).astype(int), 1, 4095)
        counts = np.bincount(lengths, minlength=4097)
        left = counts.copy()
        part = packing.linear_part(left, 4096)
        held = sum(np.bincount(sizes, minlength=4097) * many for sizes, many in part)
        assert (held + left == counts).all() and held.sum() > 0.9 * n
        used = sum(many for _, many in packing.configurations(counts, 4096))
        alone = sum(many for _, many in packing.best_fit(counts, 4096))
        assert used <= 1.001 * alone + 1


def test_price_is_the_best_configuration():
    random_ = np.random.default_rng(1)
    for _ in range(20):
        weights = random_.random(6)
        best = max(
            (float(np.dot(c, weights)) for c in np.ndindex(13, 7, 5, 4, 3, 3) if np.dot(c, np.arange(1, 7)) <= 12),
        )
        assert np.isclose(packing.price(weights, 12)[1:] @ weights, best)


def test_part_encoder_equals_the_tokenizer():
    path = public_tokenizers.path(queries.TOKENIZER)
    tokenizer, parts = Tokenizer.from_file(path), packing.PartEncoder(path)
    odd = ["It's <|endoftext|> a<|endoftext|>b don't 'VE", "é é é İx ΣΑΣ ß ẞ ŉ", "x2 12 a_b ... ²½", "a\x1cb\x85c\xa0d\x0be", "ª º ǅ Ω ﬁ ​", ""]
    texts = odd + [t or "" for _, t in corpus()]
    for text, ids in zip(texts, parts.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_part_encoder_equals_the_tokenizer_on_every_letter_it_may_cut():
    path = public_tokenizers.path(queries.TOKENIZER)
    tokenizer, parts = Tokenizer.from_file(path), packing.PartEncoder(path)
    texts = [f"a{chr(c)}b {chr(c)} 'x{chr(c)}{chr(c)}1" for c in range(1, 0x260)]
    for text, ids in zip(texts, parts.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_parts_are_cut_as_the_pattern_cuts_them():
    r = random.Random(9)
    path = public_tokenizers.path(queries.TOKENIZER)
    tokenizer, encoder = Tokenizer.from_file(path), packing.PartEncoder(path)
    pool = [*"''''stmdrevlaXZ 0129.,!-<|>_", "'ll", "'re", "'ve", "\n", "\t", "\x1c", "\x85", "\xa0"]
    pool += [*"éÉßÿ×÷²¼ªºµ¿ĀſƻǃȡȿΣ日", "é"]
    texts = ["".join(r.choices(pool, k=r.randint(0, 30))) for _ in range(1500)]
    texts += ["", " ", "'", "'s", "'re", "'r", "''s", "a'", "é", "²", "a" * 5000, "\x00", "\x85"]
    plain = [text for text in texts if encoder._is_plain(text)]
    parts, bounds = packing.cut_parts(plain)
    parts = parts.to_pylist()
    assert len(plain) > 300 and len(bounds) == len(plain) + 1 and bounds[0] == 0 and bounds[-1] == len(parts)
    for text, low, high in zip(plain, bounds, bounds[1:], strict=False):
        assert parts[low:high] == packing.PART.findall(text.lower()), text
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert list(encoder.encode([])) == [] and list(encoder.encode(["", "  "])) == [b"", b""]


class Counted:
    """A tokenizer that notes the words it is asked for."""

    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, []

    def encode_batch_fast(self, texts, **how):
        self.asked += [word for text in texts for word in text.split()]
        return self.tokenizer.encode_batch_fast(texts, **how)


def test_frequent_parts_stay_known(monkeypatch):
    """Rare parts beyond those a worker remembers do not make it encode the frequent ones again."""
    monkeypatch.setattr(packing, "CACHED_PARTS", 100)
    path = public_tokenizers.path(queries.TOKENIZER)
    tokenizer, parts = Tokenizer.from_file(path), packing.PartEncoder(path)
    parts._plain = Counted(parts._plain)
    r = random.Random(6)
    words = list(dict.fromkeys("".join(r.choices("abcdefghijklmnop", k=9)) for _ in range(900)))
    common, rare = words[:30], words[30:830]
    for low in range(0, len(rare), 40):
        text = " ".join(common * 3 + rare[low : low + 40])
        [ids] = parts.encode([text])
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(parts._plain.asked) == sorted(common + rare)


def test_parts_that_share_a_hash_keep_their_ids(monkeypatch):
    monkeypatch.setattr(packing, "word_hashes", lambda data, begin, end: (end - begin).astype(np.uint64) % np.uint64(3))
    monkeypatch.setattr(packing, "GROUP_CHARS", 2000)
    path = public_tokenizers.path(queries.TOKENIZER)
    tokenizer, parts = Tokenizer.from_file(path), packing.PartEncoder(path)
    texts = [text or "" for _, text in corpus()]
    for _ in range(2):
        for text, ids in zip(texts, parts.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pipeline_stages(spark, tmp_path):
    """Each stage's decisions against plain Python on what the stage before it kept."""
    leak = items(spark).first().text
    r = random.Random(8)
    rows = [(i, t) for i, t in corpus() if i is not None]
    rows = list(dict(rows).items())
    rows += [(900, f"{prose(r, 60)} {leak} {prose(r, 60)}"), (901, " ".join(f"{w}***" for w in prose(r, 90).split()))]
    folder = save(spark, tmp_path, documents=frame(spark, rows), benchmark=items(spark))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(x.doc_id, x.text) for x in docs.collect()]
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns or name == "suffix_array_dedup"
        path = f"{tmp_path}/{name}"
        after.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = (dict(before), {x.doc_id: x.text for x in docs.collect()})
    before, after = kept["quality_rules"]
    assert all(after[i] == before[i] for i in after) and 900 in after
    assert not any(len((before[i] or "").split()) < 50 for i in after)
    before, after = kept["simhash_near_dedup"]
    assert set(after) == {i for i, _, c in plain_components(list(before.items())) if i == c}
    before, after = kept["suffix_array_dedup"]
    gone = {i: n for i, _, n, _, _ in plain_strings(list(before.items()), 200)}
    for i, text in before.items():
        left = len(text.encode()) - gone[i]
        assert after[i] == text if not gone[i] else left - 8 <= len(after[i].encode()) <= left
    before, after = kept["benchmark_decontamination"]
    assert set(before) - set(after) == {900}
    rows_ = corpus_pipeline.run(spark, folder).collect()
    check_packing(rows_, list(after.items()), 4096)


def test_pipeline_of_nothing(spark, nothing):
    assert corpus_pipeline.run(spark, nothing).count() == 0


def test_anchors_choose_the_leftmost_least():
    from sluicegate.llm.anchors import least_in_windows, whole_windows

    values = np.array([5, 1, 1, 7, 0, 9, 1], np.uint64)
    assert least_in_windows(values, 3).tolist() == [1, 1, 4, 4, 4]
    assert least_in_windows(values, 9).tolist() == []
    assert whole_windows(np.array([0, 3, 3, 4, 7]), 7, 2).tolist() == [0, 1, 4, 5]
    hashes = np.random.default_rng(1).integers(0, 2**64, 900, dtype=np.uint64)
    hashes[300:600] = hashes[:300]
    for width in (1, 2, 7, 169, 900):
        assert (anchors.least_hash_in_windows(hashes, width) == least_in_windows(hashes, width)).all()
    assert not len(anchors.least_hash_in_windows(hashes, 901))


def test_hashes_of_windows_are_those_of_spans():
    from sluicegate.llm.frames import span_hashes, window_hashes

    codes = np.random.default_rng(2).integers(0, 2**64, 50, dtype=np.uint64)
    for width in (1, 7, 50, 51):
        at = np.arange(max(0, 51 - width))
        assert (window_hashes(codes, width, 3) == span_hashes(codes, at, at + width, 3)).all()


def test_rows_streamed_in_any_batches():
    from sluicegate.llm.frames import covered

    begin, end = covered(np.array([0, 2, 5, 9]), np.array([3, 5, 6, 12]))
    assert (begin.tolist(), end.tolist()) == ([0, 9], [6, 12])
    assert pa.array([]).null_count == 0
