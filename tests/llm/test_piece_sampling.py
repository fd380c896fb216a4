from collections import Counter

import numpy as np
import pytest

from poiforge.llm import piece_sampling as ps


@pytest.fixture(scope="module")
def pieces():
    return ps.vocabulary(ps.default_model())


def segmentations(pieces, text):
    """All segmentations of a text (without characters that lack a piece) with their probabilities, by brute force."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=ps.default_model())
    full = "▁" + text.replace(" ", "▁")

    def rest(i):
        if i == len(full):
            return [((), 0.0)]
        out = []
        for j in range(i + 1, min(len(full), i + ps.MOST) + 1):
            k = sp.piece_to_id(full[i:j])
            if sp.id_to_piece(k) == full[i:j] and np.isfinite(pieces.weight[k]):
                out += [((k, *ids), pieces.weight[k] + w) for ids, w in rest(j)]
        return out

    found = rest(0)
    total = np.logaddexp.reduce([w for _, w in found])
    return {ids: w - total for ids, w in found}


def test_log_probabilities_and_distinct_samples(pieces):
    for text in ("cats", "a cat", "the"):
        want = segmentations(pieces, text)
        for seed in range(40):
            got = ps.sample_block(pieces, [text], np.array([seed]), 4)[0]
            assert len({tuple(i.tolist()) for i, _, _ in got}) == len(got) == min(4, len(want))
            for ids, lp, inclusion in got:
                assert lp == pytest.approx(want[tuple(ids.tolist())], abs=1e-3) and inclusion <= 0


def test_inclusion_frequencies(pieces):
    want = segmentations(pieces, "cats")
    n = 3000
    found = ps.sample_block(pieces, ["cats"] * n, np.arange(n) * 7919, 2)
    first = Counter(tuple(f[0][0].tolist()) for f in found)
    both = Counter(tuple(i.tolist()) for f in found for i, _, _ in f)
    p = {k: float(np.exp(v)) for k, v in want.items()}
    for k in sorted(p, key=p.get, reverse=True)[:3]:
        second = sum(p[j] * p[k] / (1 - p[j]) for j in p if j != k)
        assert first[k] / n == pytest.approx(p[k], abs=0.04)
        assert both[k] / n == pytest.approx(p[k] + second, abs=0.04)


def test_samples_do_not_depend_on_the_block(pieces):
    texts = ["some text here", "\n\té 梦龘\U0001f600", "", "x" * 300, "a  b   c"]
    seeds = np.arange(len(texts))
    whole = ps.sample_block(pieces, texts, seeds, 2)
    for i, t in enumerate(texts):
        alone = ps.sample_block(pieces, [t], seeds[i : i + 1], 2)[0]
        assert [x[0].tolist() for x in alone] == [x[0].tolist() for x in whole[i]]


def test_long_words_leave_the_scaled_range(pieces):
    text = "龘" * 400 + " " + "zq" * 900
    (ids, lp, _), *_ = ps.sample_block(pieces, [text], np.array([1]), 2)[0]
    assert np.isfinite(lp) and ps.decode_block(pieces, [ids.astype(np.int64)]) == [text]


def test_round_trip(spark, odd_docs, no_docs):
    rows = ps.encode(odd_docs.select("doc_id", "text", "n"), 2)
    got = ps.decode(rows).join(odd_docs.select("doc_id", odd_docs["text"].alias("was")).distinct(), "doc_id").collect()
    assert all(r.text == (r.was or "") for r in got)
    counts = Counter((r.doc_id, r.sample) for r in got)
    assert counts[(4, 1)] == 1 and (4, 2) not in counts and counts[(7, 2)] == 1
    assert ps.encode(no_docs).count() == 0


def test_decoding_is_exact_for_any_text(pieces):
    texts = ["▁", "a▁b ▁ c▁", " lead", "  two  ", "\u0000\t\n", "😀▁é ", "▁▁ ▁", "x" * 3000]
    found = ps.sample_block(pieces, texts, np.arange(len(texts)), 2)
    for text, samples in zip(texts, found, strict=True):
        assert samples and all(ps.decode_block(pieces, [ids.astype(np.int64)]) == [text] for ids, _, _ in samples)


def test_arcs_are_the_pieces_and_only_beginnings_of_pieces_are_looked_up(pieces, monkeypatch):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=ps.default_model())
    known = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if np.isfinite(pieces.weight[i])}
    begun = {t[:i] for t in known for i in range(1, len(t))}
    asked, step = [], ps.Pieces.step
    monkeypatch.setattr(ps.Pieces, "step", lambda self, node, point: asked.append(len(node)) or step(self, node, point))
    words = ["▁internationalization", "▁the", "▁", "▁zqxzqx", "▁Überraschung", "▁龘\U0001f600a", "\n\tab"]
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.array([len(w) for w in words])
    lattice = ps.Lattice(pieces, points, np.cumsum(size) - size, size)
    lookups = 0
    for n, w in enumerate(words):
        for i in range(len(w)):
            row = lattice.ids[lattice.begin[lattice.word[n]] + i]
            want = [known.get(w[i:j], -1) if j <= len(w) else -1 for j in range(i + 1, i + ps.MOST + 1)]
            assert row[1:].tolist() == want[1:] and (want[0] < 0 or row[0] == want[0])
            lookups += sum(w[i : j - 1] in begun for j in range(i + 2, min(len(w), i + ps.MOST) + 1))
    assert sum(asked) == lookups  # none at the places' first characters, none past a piece that begins no other
