"""Hard negatives, token alignment and source mixing against plain-Python versions:
nulls, ties, repeats, empty tables, long texts, clashing columns, hot groups."""

import collections
import hashlib
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from martlet.llm import alignment, mixing, negatives, queries, sql


def unordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


# --- hard negatives ----------------------------------------------------------

def brute_negatives(rows, every=100, shift=7):
    usable = []
    for n, (i, x, label) in enumerate(rows):
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = (label + 1) % 10 if i is not None and i % shift == 0 else label
        usable.append((n, i, label, [math.floor(256 * c) for c in x]))
    out = []
    for n, i, label, v in usable:
        if i is None or i % every:
            continue
        scored = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j is None, j or 0, m, k) for m, j, k, w in usable
                        if m != n and len(w) == len(v))
        for p in [s for s in scored if s[4] == label][:5]:
            band = [s for s in scored if s[4] != label and -30 * p[0] <= -100 * s[0] <= -90 * p[0]][:10]
            out += [(i, None if p[1] else p[2], r, None if s[1] else s[2], -p[0], -s[0]) for r, s in enumerate(band, 1)]
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def hand_vectors():
    rnd = random.Random(5)

    def near(c, spread):
        return [float(np.float32(x + rnd.gauss(0, spread))) for x in c]

    centres = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    rows = [(i, near(centres[i % 4], 0.2), rnd.randrange(10)) for i in range(0, 900, 3)]
    rows += [(100 * i, near(centres[i % 4], 0.2), i % 10) for i in range(1, 8, 2)]   # some ids repeat
    rows += [(1000 + i, centres[0], i % 3) for i in range(300)]                       # one hot vector: ties by id
    rows += [(None, centres[1], 2), (2000, None, 1), (2100, [1.0, None], 1), (2200, [float("inf")] * 8, 1),
             (2300, [0.5] * 8, None), (2400, [0.5, 0.25], 3), (2401, [0.5, 0.2], 3), (2403, [0.4, 0.2], 4), (2500, [], 1),
             (2501, [], 1), (2502, [], 2), (2600, [0.0] * 8, 2), (-100, near(centres[2], 0.1), 5),
             (2700, [3e6] * 16, 1), (2701, [3e6] * 16, 1), (2703, [2e6] * 16, 2)]
    return rows


def test_negatives_equal_brute_force(spark):
    rows = hand_vectors()
    df = vectors(spark, rows).repartition(5)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    want = unordered(brute_negatives(rows))
    assert len(want) > 300
    assert unordered(map(tuple, negatives.mine(df, shift_every=7).collect())) == want
    assert unordered(map(tuple, negatives.mine(df, shift_every=7, per_pass=3).collect())) == want  # several passes
    assert negatives.mine(df.limit(0)).count() == 0
    clash = df.selectExpr("*", "1 as row", "2 as search", "3 as score", "4 as rank")
    assert unordered(map(tuple, negatives.mine(clash, shift_every=7).collect())) == want


def test_negatives_statement(spark):
    rows = [r for r in hand_vectors() if r[1] != [] and r[0] not in (2700, 2701, 2703)]
    con = duckdb.connect()
    con.register("t", pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()),
                                "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                                "label": pa.array([r[2] for r in rows], pa.int32())}))
    con.execute("CREATE VIEW embeddings AS SELECT * FROM t")
    assert unordered(con.execute(sql.OP11).fetchall()) == unordered(brute_negatives(rows))


def test_walk_stops_early():
    rnd = np.random.default_rng(3)
    centre = rnd.normal(size=(2, 16))
    far = (256 * np.concatenate([centre[:1] + 0.05 * rnd.normal(size=(4000, 16)),
                                 centre[1:] + 0.05 * rnd.normal(size=(4000, 16))])).astype("<i4")
    anchors = far[:50]
    low = np.full(50, -2**63)
    (s,) = negatives.clusters(np.arange(50), np.zeros(50, int), anchors, np.arange(50), low, np.full(50, 2**63 - 1))
    units, norms = negatives._units(far)
    found = negatives._Found(s, 5)
    scored = negatives.walk(found, units, norms, far, np.zeros(8000, int), np.arange(8000), np.arange(8000), True)
    assert scored <= 5000  # none of the other cluster's rows
    best = negatives.exact_scores(anchors, far)
    for i in range(50):
        order = [j for j in np.lexsort((np.arange(8000), -best[i])) if j != i][:5]
        assert found.table[2, found.table[0] == i].tolist() == order


# --- token alignment -----------------------------------------------------------

class Sides:
    """Both tokenizers as the contract names them, with each token's bytes."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in shown}
        letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
        self.letters = letters

    def tokens(self, text):
        raw = (" " + text).encode()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        x = [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in a]
        y = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
             else self.b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        return (a, x, b, y) if text and b"".join(x) == raw == b"".join(y) else None


def brute_alignment(rows):
    sides, per, count = Sides(), [], collections.Counter()
    for doc, text in rows:
        made = sides.tokens(text or "")
        if made is None:
            per.append((doc, None))
            continue
        a, x, b, y = made
        spans = [[(sum(map(len, s[:k])), sum(map(len, s[:k + 1]))) for k in range(len(s))] for s in (x, y)]
        links = [(i, j) for i, (s, e) in zip(a, spans[0]) for j, (u, v) in zip(b, spans[1]) if s < v and u < e]
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = [",".join(str(i) for i, (_, e) in zip(a, spans[0]) if lo < e <= hi) + "|"
                  + ",".join(str(j) for j, (_, e) in zip(b, spans[1]) if lo < e <= hi) for lo, hi in zip([0, *ends], ends)]
        count.update(set(links))
        per.append((doc, (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    best = collections.Counter()
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(d, 0, 0, 0, 0, 0, 0, "") if m is None else
            (d, *m[:3], len(m[3]), sum(count[p] == best[p[0]] for p in m[3]), sum(count[p] for p in m[3]), m[4]) for d, m in per]


ALIGN = [None, "", " ", "a", "a ", "  two  spaces ", "Hello world's 123\n\ttabs", "héé ΑΣ İ 😀 ß 中文字", "<|endoftext|> <s> <unk> <0x41>",
         "▁literal", "nul\x00byte", "the cat and the dog", "the cat and the dog", "the the the", "\n", "x" * 300, "naïve café " * 5]


@pytest.fixture(scope="module")
def aligned(spark):
    return spark.createDataFrame(list(enumerate(ALIGN)), "doc_id long, text string").repartition(4)


def run_alignment(df, **options):
    import public_tokenizers

    out = alignment.align(df, queries.vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                          queries.vocabulary("piece_bpe_32k.model"), **options)
    return out


def test_alignment_equals_brute_force(aligned, monkeypatch):
    want = unordered(brute_alignment(enumerate(ALIGN)))
    assert sum(r[1] == 0 for r in want) == 3
    columns = ("doc_id", "alignment.*")
    assert unordered(map(tuple, run_alignment(aligned).select(*columns).collect())) == want
    monkeypatch.setattr(alignment, "FAN", 2)  # several branches and levels of the tree
    assert unordered(map(tuple, run_alignment(aligned, chunk_chars=40).select(*columns).collect())) == want


def test_alignment_cases(spark, aligned):
    assert run_alignment(aligned.limit(0)).count() == 0
    clash = aligned.selectExpr("*", "doc_id as row", "'x' as a", "'y' as b", "1 as chunk", "2 as shard", "3 as alignment")
    out = run_alignment(clash).collect()
    assert len(out) == len(ALIGN) and all(r.row == r.doc_id and r.text == ALIGN[r.doc_id] and r.a == "x" for r in out)
    twice = aligned.where("doc_id = 11").union(aligned.where("doc_id = 11"))
    assert {r.alignment.count_sum for r in run_alignment(twice, keep_text=False).collect()} == {2 * 5}
    nothing = run_alignment(aligned.where("doc_id < 2")).collect()
    assert [r.alignment.n_a for r in nothing] == [0, 0]


def test_alignment_of_a_long_text(spark):
    text = "The cat's 12 dogs, naïve.\n" * 40_000  # over a million characters
    df = spark.createDataFrame([(1, text), (2, "The cat")], "doc_id long, text string")
    got = {r.doc_id: r.alignment for r in run_alignment(df, keep_text=False).collect()}
    per = got[1].n_a / 40_000
    assert per >= 9 and got[1].n_links >= max(got[1].n_a, got[1].n_b) and got[1].n_groups == got[1].n_a + got[1].n_b - got[1].n_links


# --- mixing --------------------------------------------------------------------

def mixed_rows():
    rnd = random.Random(11)
    rows = [(i, "b" if i % 3 else "a", " ".join(["w"] * rnd.choice([1, 3, 10, 40, 200])) + f" {i}") for i in range(600)]
    rows += [(1000 + i, "c", "copy of one text") for i in range(400)]              # a hot group of copies
    rows += [(2000 + i, None, f"no source {i}") for i in range(30)] + [(2100, "Z", None), (2101, "z", ""), (2102, "z", " \t\n")]
    rows += [(None, "d", "no id"), (None, "d", "no id"), (7, "d", "an id twice"), (7, "d", "an id twice"), (8, "d", "x " * 50_000)]
    return rows


def mix_frame(spark):
    return spark.createDataFrame(mixed_rows(), "doc_id long, source string, text string")


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:  # share, stop at the cap, share the excess again
        left = total - sum(cap * sizes[s] for s in full)
        heavy = sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and left * weight[s] >= cap * sizes[s] * heavy}
        if not more:
            return {s: float(cap * sizes[s]) if s in full else left * weight[s] / heavy for s in names}
        full |= more


def test_mix_targets_and_words(spark):
    rows = [(r.doc_id, r.source, r.mix) for r in mixing.mix(mix_frame(spark)).collect()]
    sizes = collections.Counter()
    for _, text_source, m in rows:
        sizes[text_source] += m.size
    want = brute_targets(dict(sizes))
    taken, longest = collections.Counter(), collections.Counter()
    for _, s, m in rows:
        assert m.source_size == sizes[s] and math.isclose(m.target, want[s], rel_tol=1e-12)
        assert m.taken == m.size * m.copies <= 3 * m.size and int(m.copies) in range(4)
        taken[s] += m.taken
        longest[s] = max(longest[s], m.size)
    for s, target in want.items():
        assert abs(taken[s] - target) <= max(longest[s] / 2 + 1, 1)
    for s in "abc":
        assert abs(taken[s] - want[s]) <= 0.01 * want[s] + 1
    assert {m.size for _, s, m in rows if s in ("Z", "z")} == {0}


def test_mix_equals_statement_and_reruns(spark):
    df = mix_frame(spark)
    made = [sorted(map(str, mixing.mix(x, keep_text=False).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")
                       .collect())) for x in (df.repartition(7), df.repartition(2))]
    assert made[0] == made[1]
    con = duckdb.connect()
    rows = mixed_rows()
    con.register("t", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "source": pa.array([r[1] for r in rows]),
                                "text": pa.array([r[2] for r in rows])}))
    con.execute("CREATE VIEW documents AS SELECT * FROM t")
    want = con.execute(sql.OP13).fetchall()
    assert unordered((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in want) == unordered(
        (r.doc_id, r.mix.size, r.mix.source_size, round(r.mix.target, 6), r.mix.taken) for r in mixing.mix(df).collect())


def test_mix_draws_follow_the_odds(spark):
    # 2,000 documents of one size at a third of a copy: a third of them, not the first ones by id
    df = spark.createDataFrame([(i, "a" if i < 2000 else "b", f"some words {i}") for i in range(2200)],
                               "doc_id long, source string, text string")
    out = mixing.mix(df, weights=(1, 2)).where("source = 'a'").collect()
    share = sum(r.mix.copies for r in out) / 2000
    assert abs(share - out[0].mix.target / out[0].mix.source_size) < 1e-3
    first = sum(r.mix.copies for r in out if r.doc_id < 1000)
    second = sum(r.mix.copies for r in out if r.doc_id >= 1000)
    assert abs(first - second) < 120


def test_mix_cases(spark, monkeypatch):
    df = mix_frame(spark)
    assert mixing.mix(df.limit(0)).count() == 0
    clash = df.selectExpr("*", "1 as size", "2 as src", "3 as u", "4 as rest", "5 as mix", "6 as copies")
    out = mixing.mix(clash)
    assert out.columns == ["doc_id", "source", "text", "size", "src", "u", "rest", "copies", "mix"]
    want = sorted(map(str, mixing.mix(df).select("doc_id", "mix").collect()))
    assert sorted(map(str, out.select("doc_id", "mix").collect())) == want
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)  # the salted join beyond the broadcast's bound
    assert sorted(map(str, mixing.mix(df).select("doc_id", "mix").collect())) == want
