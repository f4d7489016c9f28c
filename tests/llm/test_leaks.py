"""String tiling and removal of repeated passages."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import string_tiling, unit_dedup
from llm.odd import ODD_ROWS

RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choice("abcdefghij") for _ in range(5)) for _ in range(4000)]


def words(n, rng=RNG):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def greedy(item, text, least):
    """Greedy string tiling by the book."""
    marked_item, marked_text, tiles = [False] * len(item), [False] * len(text), []
    while True:
        best = []
        longest = least
        for i in range(len(item)):
            for t in range(len(text)):
                n = 0
                while (
                    i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n]
                    and not marked_item[i + n] and not marked_text[t + n]
                ):
                    n += 1
                if n > longest:
                    longest, best = n, [(i, t)]
                elif n == longest:
                    best.append((i, t))
        if not best:
            return tiles
        for i, t in best:
            if not any(marked_item[i : i + longest]) and not any(marked_text[t : t + longest]):
                marked_item[i : i + longest] = [True] * longest
                marked_text[t : t + longest] = [True] * longest
                tiles.append((i, t, longest))


@pytest.mark.parametrize("seed", range(40))
def test_tiles_like_the_plain_method(seed):
    rng = np.random.default_rng(seed)
    item, text = rng.integers(1, 3 + seed % 4, 30), rng.integers(1, 3 + seed % 4, 60)
    assert string_tiling.tile(item, text, 3) == greedy(item.tolist(), text.tolist(), 3)


def benchmark_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_leaks_are_found_in_any_order(spark, documents):
    item = words(60)
    reordered = item[40:] + words(3) + item[20:40] + item[:20]
    half = item[:31]
    less = item[:20]
    docs = documents(
        [
            (1, " ".join(words(200) + item + words(100))),
            (2, " ".join(words(50) + reordered)),
            (3, " ".join(w.upper() + "," for w in half)),
            (4, " ".join(words(30) + less)),
            (5, " ".join(words(500))),
            *((10 + i, t) for i, t in ODD_ROWS if i is not None),
            *((i, t) for i, t in ODD_ROWS if i is None),
        ]
    )
    items = benchmark_of(spark, [(7, " ".join(item)), (8, None), (9, ""), (10, "too short"), (None, " ".join(item))])
    for block_bytes in (32 << 20, 200):
        found = string_tiling.find_leaks(docs, items, block_bytes=block_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in found} == {(d, i) for d in (1, 2, 3) for i in (7, None)}
    by_doc = {r.doc_id: r for r in found if r.item_id == 7}
    assert by_doc[1].coverage == 1.0 and len(by_doc[1].tiles) == 1 and by_doc[1].tiles[0].doc_start == 200
    assert by_doc[2].coverage == 1.0 and len(by_doc[2].tiles) == 3
    assert by_doc[3].coverage == 31 / 60


def test_pairs_equal_tiling_of_all_pairs(spark, documents):
    items = [words(25) for _ in range(6)]
    rows = []
    for d in range(40):
        item = items[d % 6]
        cut = RNG.randrange(0, 25)
        rows.append((d, words(10) + item[cut:] + words(5) + item[:cut] if d % 3 else words(60)))
    docs = documents([(d, " ".join(t)) for d, t in rows])
    found = string_tiling.find_leaks(docs, benchmark_of(spark, [(i, " ".join(x)) for i, x in enumerate(items)]))
    expected = set()
    for d, text in rows:
        for i, item in enumerate(items):
            coverage = sum(n for _, _, n in greedy(item, text, 5)) / 25
            if coverage >= 0.5:
                expected.add((d, i, coverage))
    assert {(r.doc_id, r.item_id, r.coverage) for r in found.collect()} == expected


def test_copies_with_other_blanks_are_found(spark, documents):
    item = words(40)
    docs = documents([(n, " ".join(words(20)) + " " + blank.join(item)) for n, blank in enumerate("\u00a0\u3000\u2028\x1c\t")])
    items = benchmark_of(spark, [(1, " ".join(item)), (2, "\u00a0".join(item))])
    found = string_tiling.find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id, r.coverage) for r in found} == {(d, i, 1.0) for d in range(5) for i in (1, 2)}


def test_seeds_of_many_items_are_expanded_in_shares(monkeypatch):
    common, most = words(6), []
    items = [(n, " ".join(common + words(5))) for n in range(50)]
    index = string_tiling.SeedIndex(items, 5)
    texts = [common * 3 + words(4) for _ in range(40)] + [items[7][1].split()]
    tokens = np.array([index.vocabulary.get(w, 0) for t in texts for w in t])
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    expected = set(index.pairs(tokens, bounds, 0.5))
    assert expected == {(t, i) for t in range(41) for i in range(50)}
    covered = string_tiling.SeedIndex._covered

    def watched(self, texts, low, counts, min_coverage):
        most.append(int(counts.sum()))
        return covered(self, texts, low, counts, min_coverage)

    monkeypatch.setattr(string_tiling.SeedIndex, "_covered", watched)
    monkeypatch.setattr(string_tiling, "SEED_PLACES", 300)
    assert set(index.pairs(tokens, bounds, 0.5)) == expected and len(most) > 10 and max(most) < 600


def test_an_index_is_made_once_per_block():
    block = [(1, " ".join(words(20)))]
    assert string_tiling._index_of(block, 5) is string_tiling._index_of(block, 5)
    assert string_tiling._index_of(list(block), 5) is not string_tiling._index_of(block, 4)


def test_no_documents_or_items(spark, documents):
    item = benchmark_of(spark, [(1, " ".join(words(20)))])
    docs = documents([(1, " ".join(words(20)))])
    assert string_tiling.find_leaks(docs.limit(0), item).count() == 0
    assert string_tiling.find_leaks(docs, item.limit(0)).count() == 0


def cut(docs, **options):
    return {(r.doc_id, r.text): r for r in unit_dedup.remove_repeats(docs, **options).collect()}


def check_spans(original, row):
    assert row.text == "".join(original[s.start : s.end] for s in row.kept)
    spans = sorted([*row.kept, *row.removed], key=lambda s: s.start)
    assert [s.start for s in spans] == [0, *(s.end for s in spans[:-1])] and spans[-1].end == len(original)


def test_passages_inside_lines_are_cut_from_later_documents(spark, documents):
    rows, passages = {}, {}
    for n in range(30):
        passage = words(55)
        for copy in range(3):
            key = 100 * copy + n
            rows[key] = " ".join(words(40) + passage + words(30))
            passages[key] = " ".join(passage)
    found = {r.doc_id: r for r in unit_dedup.remove_repeats(documents(list(rows.items()))).collect()}
    assert len(found) == len(rows)
    for key, row in found.items():
        check_spans(rows[key], row)
        if key < 100:
            assert row.text == rows[key] and not row.removed
        else:
            gone = " ".join(rows[key][s.start : s.end] for s in row.removed)
            assert len(gone.split()) >= 20
            assert set(gone.split()) <= set(passages[key].split())


def test_clean_documents_stay(spark, documents):
    rows = [(i, " ".join(words(300))) for i in range(50)]
    for row in unit_dedup.remove_repeats(documents(rows)).collect():
        assert not row.removed and (row.doc_id, row.text) in rows


def test_lines_and_paragraphs(spark, documents):
    a, b, c = (" ".join(words(25)) for _ in range(3))
    docs = documents([(1, f"{a}\n{b}\n\n{c}"), (2, f"{b.upper()}!\n{c}\nnew line"), (3, f"{a}\n{b}")])
    found = {r.doc_id: r for r in unit_dedup.remove_repeats(docs, unit="line").collect()}
    assert found[1].text == f"{a}\n{b}\n\n{c}"
    assert found[2].text == "new line" and found[3].text == ""
    found = {r.doc_id: r for r in unit_dedup.remove_repeats(docs, unit="paragraph").collect()}
    assert found[2].text == f"{b.upper()}!\n{c}\nnew line" and found[3].text == ""
    with pytest.raises(ValueError):
        unit_dedup.remove_repeats(docs, unit="page")


def test_odd_rows_keep_all_columns(spark, documents):
    docs = documents(ODD_ROWS)
    out = unit_dedup.remove_repeats(docs)
    assert out.columns == [*docs.columns, "removed", "kept"]
    rows = out.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i, _ in ODD_ROWS)
    assert {r.text for r in rows if r.doc_id == 4} == {"the same row twice"}
    assert [r.text for r in rows if r.doc_id == 1] == [None]
    assert all(r.source == "host" and r._id == 7 for r in rows)
    assert unit_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_null_ids_rank_last(spark, documents):
    line = " ".join(words(40))
    found = {r.doc_id: r.text for r in unit_dedup.remove_repeats(documents([(None, line), (9, line)])).collect()}
    assert found == {9: line, None: ""}


def test_passages_are_found_however_their_lines_are_wrapped(spark, documents):
    def wrapped(text, width):
        return "\n".join(" ".join(text[k : k + width]) for k in range(0, len(text), width))

    rows, passages = {}, {}
    for n in range(40):
        passage = words(60)
        for copy, width in enumerate((100, 12, 9)):
            key = 100 * copy + n
            rows[key] = " ".join(words(30)) + " " + wrapped(passage, width) + " " + " ".join(words(30))
            passages[key] = set(passage)
    # A line of 40 words stands between others each time.
    line = words(40)
    for key in (1000, 1001):
        rows[key] = "\n".join(" ".join(w) for w in (words(30), line, words(30)))
    found = {r.doc_id: r for r in unit_dedup.remove_repeats(documents(list(rows.items()))).collect()}
    for key, row in found.items():
        check_spans(rows[key], row)
        gone = " ".join(rows[key][s.start : s.end] for s in row.removed).split()
        if key < 100 or key == 1000:
            assert not gone
        elif key == 1001:
            assert len(gone) >= 20 and set(gone) <= set(line)
        else:
            assert len(gone) >= 20 and set(gone) <= passages[key]


def test_lines_are_found_between_any_others(spark, documents):
    """Every line of 20 words or more that stands earlier goes, whatever stands around it; no other word does."""
    rows, repeats = {}, {}
    for n, size in enumerate(size for size in range(20, 61, 2) for _ in range(6)):
        line = words(size)
        for copy in range(2):
            key = 1000 * copy + n
            lines = [words(RNG.randrange(1, 40)), line, words(RNG.randrange(1, 40))]
            rows[key] = "\n".join(" ".join(w) for w in lines[n % 3 == 0 : 2 if n % 3 == 1 else 3])
            repeats[key] = set(line)
    found = {r.doc_id: r for r in unit_dedup.remove_repeats(documents(list(rows.items()))).collect()}
    for key, row in found.items():
        check_spans(rows[key], row)
        gone = " ".join(rows[key][s.start : s.end] for s in row.removed).split()
        assert set(gone) == (set() if key < 1000 else repeats[key])


def test_units_equal_plain_cutting():
    """Pieces of a text are those of the whole text and those of its lines, none twice."""
    texts = ["\n".join(" ".join(words(RNG.randrange(0, 30))) for _ in range(RNG.randrange(1, 6))) for _ in range(60)]

    def pieces(text_words):
        units = unit_dedup.Units(pa.array([" ".join(text_words)]), "piece", 7)
        return list(zip(units.first.tolist(), units.last.tolist(), units.digest.tolist()))

    for text in texts:
        expected, at = set(pieces(text.split())), 0
        for line in text.split("\n"):
            expected |= {(at + f, at + t, d) for f, t, d in pieces(line.split())}
            at += len(line.split())
        units = unit_dedup.Units(pa.array([text]), "piece", 7)
        assert set(zip(units.first.tolist(), units.last.tolist(), units.digest.tolist())) == expected
        assert len(units.first) == len(expected)


def test_columns_of_any_name_pass_through(spark):
    names = ["ordinals", "removed", "_key_hash", "_column1", "doc_id", "_id", "text", "Kept", "document", "_text_hash"]
    line = " ".join(words(30))
    rows = [("a", "b", 3, "d", i, "e", f"{line}\nown {i}", "f", "g", 9) for i in range(3)]
    found = unit_dedup.remove_repeats(spark.createDataFrame(rows, names))
    assert found.columns == [*names, "_removed", "_kept"]
    for row in found.collect():
        text = row.text if row.doc_id else row.text.split("\n")[-1]
        assert text == f"own {row.doc_id}"
        assert tuple(v for n, v in zip(names, row) if n not in ("doc_id", "text")) == ("a", "b", 3, "d", "e", "f", "g", 9)
