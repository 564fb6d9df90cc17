from __future__ import annotations

import numpy as np
import pytest

from cartlens.llm import spm_sampling as S

ODD = ["a  b\n\n c ", None, "", " ", "\n", "x▁y ▁▁z", "日本 語\n", "tail ", " head", "\t\r\x00 é", "w " * 700]


@pytest.fixture(scope="module")
def vocab():
    return S.vocabulary(S.load_pieces())


def test_words_of_many_texts_are_those_of_each_text(vocab):
    lat = S.Lattices(vocab)
    got = S.numbered(lat, ODD)
    names = [w.replace(" ", S.SPACE) for w in lat.number]
    assert [[names[i] for i in x] for x in got] == [S._WORD.findall(S.normalise(t)) for t in ODD]
    assert S.numbered(lat, [None, ""])[0].size == 0 and S.numbered(lat, []) == []


def test_an_edge_is_kept_in_few_bytes(vocab):
    lat = S.Lattices(vocab)
    S.numbered(lat, [" ".join(f"word{i}ing" for i in range(3000))])
    lat.settle()
    kept = [x for x in vars(lat).values() if isinstance(x, np.ndarray) and len(x) >= len(lat.lp)]
    assert sum(x.nbytes for x in kept) <= 13 * len(lat.lp)
    assert lat.first[-1] == len(lat.lp) and len(lat.first) == lat.states + 1
    assert (lat.upto[lat.first[1:] - 1] == 1 << 30).all()          # each state's last edge takes the rest


def test_texts_sampled_together_or_alone_are_the_same(vocab):
    texts = [*ODD, "the end of the line " * 40, "y" * 900, "antidisestablishmentarianism and so on"]
    keys = S.mix64(np.arange(len(texts), dtype=np.uint64))
    lat = S.Lattices(vocab)
    numbers = S.numbered(lat, texts)
    lat.settle()
    for i, (t, kappa) in enumerate(S.sample_paths(lat, numbers, keys, 4)):
        other = S.Lattices(vocab)
        mine = S.numbered(other, [texts[i]])
        other.settle()
        alone, own = S.sample_paths(other, mine, keys[i:i + 1], 4)[0]
        assert own == kappa and len(alone.paths) == len(t.paths)
        for a, b in zip(alone.paths, t.paths):
            assert a[2:4] == b[2:4] and a[4].tolist() == b[4].tolist()


def test_joined_ids_and_bytes_are_those_of_each_path():
    pieces = S.piece_bytes()
    assert S.SPACE.encode() in pieces
    mark = pieces.index(S.SPACE.encode())
    paths = [np.array(x, np.int32) for x in (
        [], [mark, 300, 301, mark, 400], [mark, S.FALLBACK + 0x10348, S.FALLBACK + 0xE9, 500], [], [mark])]
    ids, end = S.ids_of_all(paths)
    own = [S._ids(x) for x in paths]
    assert [x.tolist() for x in np.split(ids, end[:-1])] == [x.tolist() for x in own]
    table = S.text_bytes(pieces)
    assert [bytes(x) for x in S.decoded(ids, end, table)] == [S.decode_ids(x.tobytes(), pieces).encode() for x in own]
    ids, end = S.ids_of_all([np.empty(0, np.int32)] * 2)
    assert [bytes(x) for x in S.decoded(ids, end, table)] == [b"", b""]
    assert len(S.ids_of_all([])[0]) == 0
