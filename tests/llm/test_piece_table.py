"""The table of pieces that every tokenizing task holds stays small."""

import tracemalloc

import numpy as np

from ledgerloom.llm.tokens import PieceTable


def _find(table: PieceTable, pieces: list[bytes]) -> list[bytes]:
    ends = np.cumsum([len(p) for p in pieces]).astype(np.int64)
    slots = table.find(b"".join(pieces), np.concatenate([[0], ends[:-1]]), ends)
    return [table.ids(slots[i:i + 1]).astype("<u4").tobytes() for i in range(len(pieces))]


def test_a_piece_takes_few_bytes():
    table, n, step = PieceTable(lambda pieces: [b"\1\0\0\0"] * len(pieces)), 100_000, 10_000
    tracemalloc.start()
    for k in range(0, n, step):
        pieces = [b"%08d" % i for i in range(k, k + step)]
        ends = np.arange(8, 8 * step + 1, 8)
        table.find(b"".join(pieces), ends - 8, ends)
    del pieces, ends
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(table.slots) == n and held < 50 * n


def test_pieces_come_back_in_any_order_and_after_a_new_start():
    made = []

    def encode(pieces: list[bytes]) -> list[bytes]:
        made.extend(pieces)
        return [p.ljust(4, b"\0") * (1 + len(p) % 3) for p in pieces]
    table = PieceTable(encode, most=5)
    for pieces in ([b"b", b"a", b"b"], [b"c", b"a"], [b"f", b"e", b"d", b"b"], [b"a", b"zz", b"a"]):
        assert _find(table, pieces) == [p.ljust(4, b"\0") * (1 + len(p) % 3) for p in pieces]
    assert sorted(made) == [b"a", b"a", b"b", b"c", b"d", b"e", b"f", b"zz"]
