"""Every text operator against brute force on small fixtures, with the odd rows and on empty tables."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rowlens.llm import lines, minhash, mixing, packing, sharding, substring, tokencount, toxicity


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_substring_equals_brute_force(make, odd_rows):
    found = by_id(substring.remove_repeats(make(odd_rows), with_text=True))
    first = {}
    for doc, text in sorted({(r[0], r[1]) for r in odd_rows if r[0] is not None}, key=lambda r: r[0]):
        w = words(text)
        gone = set()
        for i in range(len(w) - 19):
            if first.setdefault(tuple(w[i : i + 20]), (doc, i)) != (doc, i):
                gone |= set(range(i, i + 20))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        row = found[doc]
        assert (row.n_words, row.n_removed, row.kept_text) == (len(w), len(gone), kept)
        assert row.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert found[None].n_removed == 0 and found[7].n_removed == 60


def test_automaton_matches_every_window():
    rng = np.random.default_rng(3)
    reference, stream = [rng.integers(0, 3, 200).tolist() for _ in range(3)], rng.integers(0, 3, 300).tolist()
    automaton, flat = substring.Automaton(), []
    for r in reference:
        automaton.add(r, len(flat))
        flat += r
    inside = [i for r, base in zip(reference, (0, 200, 400)) for i in range(base + 5, base + 200)]
    for n, end in enumerate(automaton.matches(stream, 6)):
        window = stream[n - 5 : n + 1] if n >= 5 else None
        ends = [i for i in inside if window and flat[i - 5 : i + 1] == window]
        assert end == (min(ends) if ends else -1)


def test_minhash_equals_brute_force(make, odd_rows):
    base = words(odd_rows[0][1])
    rows = odd_rows + [(20 + i, " ".join([*base[:i], "new", *base[i + 1 :]])) for i in range(0, 60, 9)]
    found = by_id(minhash.near_texts(make(rows)))
    sets = {}
    for doc, t in [r[:2] for r in rows if r[0] is not None]:
        w = words((t or "").lower())
        sets[doc] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} - {()}
    home = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                    home[a] = home[b] = min(home[a], home[b])
    assert {d: (found[d].n_shingles, found[d].component_id, found[d].kept) for d in sets} == {d: (len(s), home[d], home[d] == d) for d, s in sets.items()}
    assert found[None].component_id is None and found[None].kept


def test_registers_estimate_similarity():
    rng = np.random.default_rng(5)
    one = np.unique(rng.integers(0, 2**64, 3000, np.uint64))
    two = np.unique(np.concatenate([one[600:], rng.integers(0, 2**64, 600, np.uint64)]))
    share = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
    sketches = minhash.registers([one, two, one[:3], one[:0]])
    assert abs(minhash._estimate(sketches[:1], sketches[1:2])[0][0, 0] - share) < 0.2
    assert (sketches[2] != 0xFFFF).all() and (sketches[3] == 0xFFFF).all()


def test_lines(make, odd_rows):
    near = "the quick brown fox jumps over the lazy dog near the river bank while seven other animals watch quietly from far away hills"
    rows = odd_rows + [(30, "Plain LINE!\nnew line here\n---\n---"), (31, near + "\n" + near.replace("dog", "dog,"))]
    df = make(rows)
    out = lines.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed"]
    found = by_id(out)
    assert found[30].text == "new line here\n---\n---" and found[30].n_removed == 1
    assert found[31].text == near
    assert found[2].text is None and found[3].text == "" and found[None].text == odd_rows[0][1]
    assert found[11].text == words_line(odd_rows) + "\nplain line" and found[1].n_removed == 0 and found[10].text == ""


def words_line(rows):
    return rows[-1][1].split("\n")[0]


def edit_distance(a, b):
    row = np.arange(len(b) + 1)
    chars, at = np.array(list(b)), np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (chars != x))])
        row = np.minimum.accumulate(new - at) + at
    return int(row[-1])


def changed_lines():
    """Lines of 1 to 200 words, and each of them with a word changed, with one left out and with typing errors."""
    rng = np.random.default_rng(11)
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    vocabulary, out = [word(int(n)) for n in rng.integers(2, 9, 600)], []
    for n in [1, 2, 3, 4, 5, 8, 8, 8, 12, 20, 20, 40, 80, 200]:
        line = [str(w) for w in rng.choice(vocabulary, n)] if n > 1 else [word(19)]
        out.append(" ".join(line))
        for _ in range(2):
            k = int(rng.integers(n))
            out += [" ".join([*line[:k], word(4), *line[k + 1 :]]), " ".join([*line[:k], *line[k + 1 :]])]
            text = list(" ".join(line))
            for at in rng.choice(len(text), max(1, len(text) // 40), replace=False):
                text[at] = "q"
            out.append("".join(text))
    return [line for line in dict.fromkeys(out) if line.strip()]


def test_near_lines_equal_brute_force(make):
    rows = changed_lines()
    joined = [" ".join(re.findall(r"[^\W_]+", line)) for line in rows]
    home = list(range(len(rows)))
    for b in range(len(rows)):
        for a in range(b):
            most = max(len(joined[a]), len(joined[b]))
            if home[a] != home[b] and 10 * edit_distance(joined[a], joined[b]) <= most:
                home = [min(home[a], home[b]) if h in (home[a], home[b]) else h for h in home]
    found = lines.dedup_lines(make([(5, "\n".join(rows))])).first()
    assert found.text.split("\n") == [rows[a] for a in sorted(set(home))]


def test_segment_keys_find_every_short_pair(llm):
    rng = np.random.default_rng(12)
    pairs = []
    for size in [9, 10, 14, 19, 20, 25, 29, 30, 35, 39] * 12:
        one = two = "".join(rng.choice(list("ab "), size))
        for _ in range(size // 10):
            k = int(rng.integers(len(two)))
            two = two[:k] + "xy"[int(rng.integers(2))] * int(rng.integers(3)) + two[k + 1 :]
        if len(one) <= 39 and len(two) <= 39 and 10 * edit_distance(one, two) <= max(len(one), len(two)):
            pairs.append((one, two))
    df = llm.createDataFrame(pairs, "a string, b string")
    kept = df.selectExpr("a", "b").select(*(lines.segment_keys(df[c]).alias(c) for c in "ab")).collect()
    assert len(pairs) > 50 and all(set(r.a) & set(r.b) for r, (a, b) in zip(kept, pairs) if a != b)


def test_block_keys_find_every_pair_of_few_bits(llm):
    """SimHashes of 128 bits that differ in fewer bits than there are blocks agree in a block, whatever bits these are."""
    rng = np.random.default_rng(2)
    rows = []
    for n in range(200):
        bits = rng.integers(0, 2, 128)
        near = bits.copy()
        near[rng.choice(128, lines.BLOCKS - 1, replace=False)] ^= 1
        for b in (bits, near):
            s1, s2 = (int("".join(map(str, part[::-1])), 2) for part in (b[:64], b[64:]))
            rows.append((n, s1 - (s1 >> 63 << 64), s2 - (s2 >> 63 << 64), 50, []))
    df = llm.createDataFrame(rows, "n long, s1 long, s2 long, size int, keys array<long>")
    pairs = {}
    for r in df.select("n", lines.block_keys(lines.SIMILAR).alias("keys")).collect():
        pairs.setdefault(r.n, []).append({k >> lines.BESIDE for k in r["keys"]})
    assert all(len(a) == lines.BLOCKS * lines.ARRANGEMENTS and a & b for a, b in pairs.values())


def test_shards(make, odd_rows):
    rows = odd_rows + [(100 + i, "same text" if i % 3 == 0 else f"text {i} " * (i % 17)) for i in range(600)]
    found = sharding.shard_rows(make(rows), shards=4).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in found) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows
    )
    for s in {r.shard for r in found}:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))


def test_shards_are_near_equal_whatever_is_equal(make):
    """A third of the rows equal in text and key (null, or not), equal in text alone, and all rows equal."""
    others = [(i, f"text {i} " * (1 + i % 13)) for i in range(4000)]
    thirds = [[(None, "the same text " * 7)] * 2000, [(-5, "the same text " * 7)] * 2000, [(10_000 + i, "the same text " * 7) for i in range(2000)]]
    for rows in [others + t for t in thirds] + [[(None, "x")] * 3000]:
        found = sharding.shard_rows(make(rows), shards=8).collect()
        held = np.bincount([r.shard for r in found], [r["size"] for r in found], minlength=8)
        assert len(found) == len(rows) and held.max() < 1.05 * held.mean() and held.min() > 0.95 * held.mean()
        for s in range(8):
            assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))


def test_token_counts(make, odd_rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(tokencount.TOKENIZER))
    rows = odd_rows + [(50, "It's <|endoftext|> ÀÉÎ Σίσυφος x  don't　go 12345 é")]
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    for r in tokencount.token_prefixes(make(rows)).collect():
        t = next(x[1] for x in rows if x[0] == r.doc_id) or ""
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), count(t))
    row = tokencount.token_prefixes(make(rows[-1:]), within_words=True).first()
    assert [row.counts[n] for n in range(len(rows[-1][1]) + 1)] == [count(rows[-1][1][:n]) for n in range(len(rows[-1][1]) + 1)]
    cut = tokencount.token_prefixes(make(rows[:1])).select(tokencount.bytes_within(20).alias("b")).first().b
    assert count(rows[0][1].encode()[:cut].decode()) <= 20


@pytest.mark.parametrize("within", [False, True])
def test_token_counts_hold_when_the_memory_starts_anew(monkeypatch, within):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(tokencount.TOKENIZER))
    monkeypatch.setattr(tokencount, "REMEMBERED", 20)
    monkeypatch.setattr(tokencount, "_tokenizers", {})
    for low in (0, 10, 25, 25):
        texts = [f"the word{i} un{i}seen" for i in range(low, low + 30)] + [None]
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["id", "value"])
        counted = tokencount._prefixes(batch, tokencount.TOKENIZER, within)
        assert counted.column(2).to_pylist() == [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_packing(make, odd_rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = [r for r in odd_rows if r[0] is not None and r[0] != 7] + [(60, "a <|endoftext|> b c")]
    ids = {r[0]: tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in rows}
    pieces = packing.pack(make(rows), with_ids=True).collect()
    have = {d: {} for d in ids}
    for p in pieces:
        assert p.ids == ids[p.doc_id][p.start : p.start + p.length] and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        have[p.doc_id].update(dict.fromkeys(range(p.start, p.start + p.length), 1))
    assert {d: len(x) for d, x in have.items()} == {d: len(x) for d, x in ids.items()} and sum(p.length for p in pieces) == sum(map(len, ids.values()))
    for s in {p.sequence_id for p in pieces}:
        at = 0
        for p in sorted((p for p in pieces if p.sequence_id == s), key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024


def test_differencing_balances():
    sizes = np.random.default_rng(1).integers(1, 1024, 300).tolist()
    at, sums = packing.difference(sizes, 160)
    assert np.bincount(at, sizes, minlength=160).astype(int).tolist() == sums.tolist() and sums.max() - sums.min() < 400


def test_windows_rise_until_none_is_over_capacity():
    """Items of all sizes, of about two thirds of a window, all equal, one, and more than a window; windows hold every token once."""
    rng = np.random.default_rng(1)
    cases = [rng.integers(low, high, 512).tolist() for low, high in ((1, 1024), (200, 1024), (600, 700), (1023, 1024), (1, 2))]
    cases += [[700] * 512, [1024] * 7, [5], [513] * 2, [3000, 10, 1]]
    for sizes in cases:
        pieces = packing.pack_sizes(sizes, 1024)
        assert np.bincount([i for i, *_ in pieces], [n for _, _, n, _ in pieces]).astype(int).tolist() == sizes
        ends = {}
        for i, start, n, _ in sorted(pieces):
            assert n > 0 and start == ends.get(i, 0)
            ends[i] = start + n
        filled = np.bincount([w for *_, w in pieces], [n for _, _, n, _ in pieces])
        least = -(-sum(sizes) // 1024)
        assert filled.min() > 0 and filled.max() <= 1024 and len(filled) - least <= max(1, 0.025 * len(filled))
    at, sums = packing.difference([700] * 6, 5)  # without a cut, two items of 700 cannot share a window
    assert sums.max() == 1400 and [n for *_, n in packing.cut_some([700] * 6, 0.0, 32)] == [700] * 6


def test_plain_texts_have_the_ids_of_the_tokenizer():
    """Both ways of encoding, on texts of letters, digits, marks, white space and code points of many blocks."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rng = np.random.default_rng(8)
    marks = list("aZ é09'’.,!?-_/\\\t\n\r \u00a0\u00ad\u0301\u200b\u3000ßıſΩжא中😀²½") + ["'s", "'LL", "  ", "\n\n", "<|endoftext|>", "the", " and"]
    texts = ["".join(rng.choice(marks, rng.integers(0, 30))) for _ in range(3000)]
    texts += ["".join(chr(c) for c in rng.integers(32, 0x250, 20)) for _ in range(1000)]
    for t, ids in zip(texts, packing._encode(texts, packing.TOKENIZER, packing.RANKS), strict=True):
        assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_mixture(make, odd_rows):
    rows = odd_rows + [(200 + i, "word " * (i % 9), ["a", "b", None][i % 3]) for i in range(90)]
    sizes = [len(words(r[1])) for r in rows]
    plan_rows, plan = mixing.mixture(make(rows))
    taken = mixing.taken_words(plan_rows, plan).collect()
    assert sorted(r["size"] for r in taken) == sorted(sizes)
    order = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for n, r in zip(sizes, rows) if r[2] == s) for s in order}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_ = dict.fromkeys(order, 0.0), set(order)
    while open_:  # share by weight, cap, share the excess again
        rest = 1.5 * sum(size.values()) - sum(target[s] for s in order if s not in open_)
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s]}
        target.update({s: 2.0 * size[s] for s in over} if over else share)
        open_ = open_ - over if over else set()
    name = lambda s: "n" if s is None else "s" + s
    for s in order:
        mine = [r for r in taken if r._source == name(s)]
        assert mine[0].target == pytest.approx(target[s]) and all(0 <= r.taken <= 2 * r["size"] for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= 1
    assert mixing.mix_documents(make(rows)).columns == make(rows).columns


def test_mixture_divides_rows_that_share_a_key(make):
    rows = [(None, f"text {i} " + "word " * (i % 7), "a") for i in range(40)] + [(None, "same words here now", "b")] * 30
    rows += [(i, "one two three", "c") for i in range(100)] + [(9, "five words are in here", None)] * 50
    plan_rows, plan = mixing.mixture(make(rows), weights=(3, 2, 4, 1), share=0.5)
    taken, mixed = mixing.taken_words(plan_rows, plan).collect(), mixing.mix_documents(make(rows), weights=(3, 2, 4, 1), share=0.5).collect()
    for s in ("a", "b", "c", None):
        mine = [r for r in taken if r._source == ("n" if s is None else "s" + s)]
        assert len(mine) == sum(r[2] == s for r in rows) and mine[0].target > 0
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 0.5
        whole = mine[0].whole
        assert sum(0 < r.taken - whole * r["size"] < r["size"] for r in mine) <= 1
        got = sum(len(words(r.text)) for r in mixed if r.source == s)
        assert abs(got - mine[0].target) <= max(r["size"] for r in mine) / 2 + 1


def test_lexicon_automaton_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    terms = ["idiot", "moron", "scum", "stupid"]
    automaton = toxicity.LexiconAutomaton([(t, False) for t in terms])
    rng = np.random.default_rng(4)
    tries = ["idiot", "id1ot", "idot", "idiiot", "scum", "scam", "stpid", "mo", "", "xidiot"]
    tries += ["".join(rng.choice(list("idotmrnscupx"), rng.integers(1, 7))) for _ in range(500)]
    for word in tries:
        expected = min((d for t in terms if (d := distance(word, t)) <= (len(t) >= toxicity.FUZZY)), default=2)
        assert automaton.distance(word) == expected
    stems = toxicity.LexiconAutomaton([("idio", True)])
    assert stems.distance("idiotic") == 0 and stems.distance("odio") == 2


def test_toxicity_learns_and_quotes_count_apart(make, llm):
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(400):
        w = [f"word{x}" for x in rng.integers(0, 300, 40)]
        if i % 5 == 0:
            for k in rng.integers(0, 40, 3):
                w[k] = "grumblefitz"
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 5 == 0)))
    rows += [(1000, None), (1001, ""), (1002, "grumblefits " * 3), (1003, "clean words only"), (None, "x")]
    scored = by_id(toxicity.score_documents(make(rows), llm.createDataFrame(labels, "doc_id long, toxic int")))
    assert all(scored[i].predicted == t for i, t in labels)
    assert scored[1000].score == scored[1001].score < 0.7 and scored[None].held_out is False
    assert all(scored[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in labels)


def test_short_words_are_terms_and_quotations_are_apart(make, llm):
    """Toxic rows marked only by words of one, three and eight letters; clean rows that quote the long one."""
    rng = np.random.default_rng(10)
    rows, labels = [], []
    for i in range(900):
        w = [f"word{x}" for x in rng.integers(0, 300, 40)]
        at = int(rng.integers(5, 35))
        toxic = i % 5 == 0
        if toxic:
            for k in rng.choice(40, 3, replace=False):
                w[k] = ("zog", "ж", "grumblef")[i // 5 % 3]
        elif i % 100 == 1:
            w[at] = '"grumblef"'
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    model = toxicity.fit_toxicity(make(rows), llm.createDataFrame(labels, "doc_id long, toxic int"))
    assert {("zog", False), ("ж", False)} <= set(model.terms)
    found = {r.doc_id: r.score for r in make(rows).select("doc_id", toxicity.score_column(model, "text").alias("score")).collect()}
    out = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all((found[i] >= 0.7) == (i % 5 == 0) for i in out)
    # The quotations of held-out rows, and the same rows without quotation marks.
    plain = make([(i, t.replace('"', "")) for i, t in rows if i % 100 == 1]).select("doc_id", toxicity.score_column(model, "text").alias("score")).collect()
    assert len(plain) == 9 and all(found[r.doc_id] < r.score - 0.05 for r in plain)


def test_lexicon_has_no_bound_of_its_own(make, llm):
    """700 strong terms of three letters, so that no stem stands for several: all are learnt."""
    rng = np.random.default_rng(13)
    letters = "abcdefghij"
    terms = [letters[n // 100] + letters[n // 10 % 10] + letters[n % 10] for n in range(700)]
    rows = [(i, " ".join(rng.permutation(terms)[:350])) for i in range(120)] + [(1000 + i, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 9))) for i in range(400)]
    model = toxicity.fit_toxicity(make(rows), llm.createDataFrame([(d, int(d < 1000)) for d, _ in rows], "doc_id long, toxic int"))
    assert {t for t, _ in model.terms} == set(terms)


def test_empty_tables(make, llm):
    none = make([])
    labels = llm.createDataFrame([], "doc_id long, toxic int")
    made = [
        substring.remove_repeats(none),
        minhash.near_texts(none),
        lines.dedup_lines(none),
        sharding.shard_rows(none),
        toxicity.score_documents(none, labels),
        tokencount.token_prefixes(none),
        mixing.taken_words(*mixing.mixture(none)),
        mixing.mix_documents(none),
        packing.pack(none),
    ]
    assert [df.count() for df in made] == [0] * len(made)
