"""Token counts, spelling variants and conversation prefixes against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sluicegate.llm import prefix_trie, queries, spelling, token_counts
from tests.llm.texts import corpus, frame, prose, save


def bag(rows) -> Counter:
    return Counter(tuple(row) for row in rows)


def library(name: str):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return path, lambda text: len(model.encode(text))
    model = Tokenizer.from_file(path)
    return path, lambda text: len(model.encode(text, add_special_tokens=False).ids)


def long_texts() -> list[tuple[int | None, str | None]]:
    """Texts whose chunks meet in words, marks, runs without spaces and special tokens."""
    r = random.Random(3)
    odd = "don't <|endoftext|> éé İx 12'ves  a \t b\n日本語。 ▁x x2"
    made = [
        prose(r, 900),
        " ".join(odd for _ in range(120)),
        odd.replace(" ", "") * 90,
        "x" * 4000,
        "ab " * 3000,
        "a1" * 900 + prose(r, 400) + "́" * 700 + prose(r, 90),
    ]
    return [*corpus(), *enumerate(made, 5000), (5000, made[0]), (None, made[1])]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_equal_the_library(spark, name):
    path, count = library(name)
    rows = long_texts()
    found = token_counts.count_tokens(frame(spark, rows), path, chunk=500, overlap=30)
    assert bag(found.collect()) == Counter((i, len((t or "").encode()), count(t or "")) for i, t in rows)


def test_seams_stand_where_both_sides_agree():
    path, _ = library("word_bpe_49k.json")
    known = token_counts.tokenizer_at(path)
    text = prose(random.Random(1), 300)
    ranges = token_counts.cuts(len(text), 200, 60)
    assert all(a[1] - b[0] == 60 for a, b in zip(ranges, ranges[1:], strict=False)) and ranges[-1][1] == len(text)
    for a, b in zip(ranges, ranges[1:], strict=False):
        (_, places, _), = token_counts.seam_sides(known, text[slice(*a)], 60, True, False)[1]
        (_, others, _), = token_counts.seam_sides(known, text[slice(*b)], 60, False, True)[1]
        assert set(places) & set(others) and all(text[b[0] + p] == " " for p in places)


def test_token_count_query(spark, tmp_path):
    path, count = library(queries.TOKENIZER)
    rows = [*corpus(), (7000, prose(random.Random(2), 30000))]
    found = queries.op13_token_counts(spark, save(spark, tmp_path, documents=frame(spark, rows)))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [(i, len((t or "").encode()), count(t or "")) for i, t in rows]
    assert bag(found.collect()) == Counter((*row, row[2] > 2048) for row in expected)


def test_token_counts_of_nothing_and_odd_names(spark):
    path, count = library(queries.TOKENIZER)
    assert not token_counts.count_tokens(frame(spark, []), path).collect()
    renamed = spark.createDataFrame([("k", "a b c " * 200)], "`doc-id` string, `n_tokens` string")
    found = token_counts.count_tokens(renamed, path, chunk=100, overlap=20, id_column="doc-id", text_column="n_tokens")
    assert [tuple(r) for r in found.collect()] == [("k", 1200, count("a b c " * 200))]
    with pytest.raises(ValueError, match="overlap"):
        token_counts.count_tokens(renamed, path, chunk=100, overlap=50)


def misspelt(r: random.Random) -> list[tuple[int | None, str | None]]:
    """Texts with words one and two edits apart, chains of them, repeated letters, marks and hot bigrams."""
    stems = ["plain", "river", "größe", "naïve", "aaaaa", "abababab", "x" * 40, "ÀÉÎõü", "walking", "a×b÷c"]
    letters = "abeix\u00c0\u00e9\u00d7"

    def edited(word: str) -> str:
        at, kind = r.randrange(len(word)), r.randrange(3)
        return word[:at] + (r.choice(letters) if kind else "") + word[at + (kind != 1) :]

    pool = [w for w in stems for _ in range(40)]
    for stem in stems:
        word = stem
        for many in (12, 6, 3, 3):
            word = edited(word)
            pool += [word] * many + [edited(stem)] * 3 + [edited(word).upper()] * 2
    r.shuffle(pool)
    rows = [(i, " ".join(pool[i::30]) + r.choice(["", "!", " 1word2word\n"])) for i in range(30)]
    return [*rows, *corpus(), (None, "plain rivers plain"), (5, "plains plains' plain-s")]


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows) -> Counter:
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts: Counter[str] = Counter()
    for i, text in rows:
        for word in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            word = word.translate(lower)
            h = zlib.crc32(f"{i}:{word}".encode())
            if i is not None and h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    links = defaultdict(list)
    for a in words:
        for b in words:
            if near(a, b):
                links[a].append(b)
    forms = {}
    for w, others in links.items():
        best = min(others, key=lambda o: (-words[o], o))
        if words[best] >= 2 * words[w]:
            forms[w] = best

    def root(w: str) -> str:
        while w in forms:
            w = forms[w]
        return w

    return Counter((w, forms.get(w), root(w), n, len(links[w]), words[forms[w]] if w in forms else None) for w, n in words.items())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spelling_query_equals_all_pairs(spark, tmp_path, seed):
    rows = misspelt(random.Random(seed))
    found = queries.op12_spelling(spark, save(spark, tmp_path, documents=frame(spark, rows)))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = plain_variants(rows)
    assert any(form and root != form for _, form, root, *_ in expected)
    assert bag(found.collect()) == expected


def test_pivots_are_the_cheapest_disjoint_bigrams():
    r = random.Random(4)
    for _ in range(300):
        places = sorted(r.sample(range(9), r.randint(3, 7)))
        costs = [r.randint(0, 5) for _ in places]
        chosen = spelling.pivots(places, costs)
        fits = [(i, j) for i in range(len(places)) for j in range(i) if places[i] - places[j] >= 2]
        assert len(chosen) == 2 and places[chosen[1]] - places[chosen[0]] >= 2
        assert sum(costs[i] for i in chosen) == min(costs[i] + costs[j] for i, j in fits)


def test_spelling_of_nothing(spark):
    assert not spelling.variants(frame(spark, [])).collect()
    assert not spelling.variants(frame(spark, [(1, None), (2, ""), (3, "one two")])).collect()
    found = spelling.variants(frame(spark, [(1, "plain plain plain")])).collect()
    assert [tuple(r) for r in found] == [("plain", None, "plain", 3, 0, None)]
    with pytest.raises(ValueError, match="letters"):
        spelling.variants(frame(spark, []), least_letters=3)
    with pytest.raises(ValueError, match="twice"):
        spelling.variants(frame(spark, []), ratio=1)


TURNS = "conv_id long, turn int, role string, text string, id string, near string, steps string, path string"


def talks(r: random.Random) -> list[tuple[int | None, int | None, str | None, str | None]]:
    """Conversations that share beginnings, copies of one, a long one, absent bases, null and repeated turns."""
    said = ["", "hi", "hello", "héllo", "no", None, "a,b", "日本"]
    rows = []
    for c in [*range(0, 60), *range(100, 130), *range(205, 260), -150, -100, -7, 70_000, 70_001, 140_000, 5_000_000_000]:
        copy = r.random() < 0.3
        for turn in range(7 if copy else r.choice([0, 1, 2, 3, 5, 8])):
            text = f"turn {turn}" if copy else r.choice(said[:3] if turn < 3 else said)
            rows.append((c, turn * 2, "user" if turn % 2 else None, text))
    rows += [(31, None, "system", "before all"), (31, 0, "u", "ser"), (31, 0, "us", "er"), (None, 1, "user", "nobody's")]
    rows += [(300, turn, "user", f"{turn % 7}") for turn in range(900)] + [(301, turn, "user", f"{turn % 7}") for turn in range(700)]
    rows += [rows[40], rows[40]]
    r.shuffle(rows)
    return rows


def digest(row) -> bytes:
    who, said = (row[2] or "").encode(), (row[3] or "").encode()
    return hashlib.md5(str(len(who)).encode() + b":" + who + said).digest()


def plain_nodes(rows) -> Counter:
    own = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, digest(r))):
        own[row[0]].append((row[2] or "", row[3] or ""))
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(rebuilt):
        path = rebuilt[c]
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
    leaves, saved = Counter(), Counter()
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(who) - 1) * (len(node[-1][1]) if node else 0)
    return Counter(
        (
            who[0],
            len(node),
            members[node[:-1]][0] if node else None,
            len(who),
            len(children[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, who in members.items()
    )


def turns(spark, rows):
    return spark.createDataFrame([(*row, "z", "z", "z", "z") for row in rows], TURNS).repartition(3)


@pytest.mark.parametrize(("seed", "shard_steps"), [(1, 20_000), (2, 400), (3, 60), (4, 5)])
def test_prefix_trie_equals_plain_prefixes(spark, tmp_path, monkeypatch, seed, shard_steps):
    rows = talks(random.Random(seed))
    found = prefix_trie.prefix_nodes
    monkeypatch.setattr(prefix_trie, "prefix_nodes", lambda s: found(s, shard_steps=shard_steps))
    monkeypatch.setattr(prefix_trie, "HELD_BYTES", 4000)
    result = queries.op11_prefix_trie(spark, save(spark, tmp_path, conversations=turns(spark, rows)))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert result.columns == names and {t for _, t in result.dtypes} == {"bigint", "string"}
    assert bag(result.collect()) == plain_nodes(rows)


def test_many_members_of_one_path_in_blocks(spark):
    ids = [i * 7 - 90_000 for i in range(30_000)]
    sequences = spark.createDataFrame([(i,) for i in ids], "id long").selectExpr("id", "array(struct(unhex(md5('a')) as key, 3L as size)) as steps")
    root, leaf = sorted(map(tuple, prefix_trie.prefix_nodes(sequences.repartition(5)).collect()), key=lambda r: r[1])
    whole = hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    assert leaf == (min(ids), 1, min(ids), 30_000, 0, 1, 3 * 29_999, whole)
    assert root[:7] == (min(ids), 0, None, 30_000, 1, 1, 3 * 29_999)


def test_splitters_are_shortest_prefixes_in_order():
    r = random.Random(6)
    paths = [b"".join(bytes([r.randrange(3)]) * 16 for _ in range(r.randrange(9))) for _ in range(500)]
    cuts = prefix_trie.splitters(paths, 20)
    assert 10 < len(cuts) < 20 and cuts == sorted(set(cuts)) and all(any(p.startswith(c) for p in paths) for c in cuts)
    assert sum(map(len, prefix_trie.splitters(paths, 20, 30))) <= 30 * 16
    skeleton = prefix_trie.Skeleton(cuts)
    assert sorted(skeleton.shard(p) for p in paths) == [skeleton.shard(p) for p in sorted(paths)]
    for a, b in zip(paths, paths[1:], strict=False):
        same = prefix_trie.common_steps(a, b)
        assert a[: same * 16] == b[: same * 16] and a[same * 16 : same * 16 + 16] != b[same * 16 : same * 16 + 16] or same * 16 in (len(a), len(b))


def test_prefix_trie_of_nothing(spark, tmp_path):
    assert not queries.op11_prefix_trie(spark, save(spark, tmp_path, conversations=turns(spark, []))).collect()
    result = queries.op11_prefix_trie(spark, save(spark, tmp_path / "b", conversations=turns(spark, [(None, 1, "a", "b")])))
    assert not result.collect()
