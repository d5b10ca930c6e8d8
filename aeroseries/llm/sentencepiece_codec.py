"""SentencePiece encoding and decoding by batched Viterbi (operator 5).

A text is normalised as the model asks (spaces become U+2581, one in front) and
cut into words: runs of U+2581 and what follows.  No piece reaches over such a
cut, so each word has a best segmentation of its own.  Equal words are
segmented once; words of equal length (and, where those are few, of up to half
that length) advance together: at every end position the hashes of all
substrings up to the longest piece probe the sorted keys of the pieces, and a
vectorised maximum keeps the best piece and its backpointer.

A unigram model scores a segmentation by the sum of its pieces' scores (ties:
the longer last piece).  A merge (BPE) model has no such sum; its segmentation
is the only one in which every two neighbours are what merging their joint text
yields.  So there the step from one piece to the next is worth 0 or minus
infinity, and the same maximum finds the library's own ids.  Whether two pieces
may stand side by side follows from the merges inside each: a piece at the seam
that could merge with its neighbour before merging on its own side forbids it.

Characters that no piece covers become byte pieces.

Defined results: a null text gives null ids and no verdict on the round trip;
an empty text has no ids; U+2581 in a text decodes as a space; other columns
pass through unread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroseries.llm import kernels as K

K.ship_by_value(__name__)
SPACE = "▁"
UNIGRAM, BPE = 1, 2
_BITS = 20
START, UNKNOWN = -2, -1


def _fields(data: bytes):
    """(number, value) of a protobuf message's fields."""
    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[i]
            value |= (byte & 127) << shift
            i, shift = i + 1, shift + 7
            if byte < 128:
                return value, i

    i = 0
    while i < len(data):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        else:
            size, i = varint(i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = data[i:i + size], i + size
        yield tag >> 3, value


def model_type(model: bytes) -> int:
    """The type that a model file names: 1 unigram (also where none is named), 2 BPE."""
    trainer = next((v for k, v in _fields(model) if k == 2), b"")
    return next((v for k, v in _fields(trainer) if k == 3), UNIGRAM)


def load(path: str) -> dict[str, np.ndarray]:
    """The pieces of a SentencePiece model file, as arrays that executors share."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    with open(path, "rb") as f:
        kind = model_type(f.read())
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    pieces = [sp.id_to_piece(i) for i in plain]
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("a piece reaches over the start of a word")
    size = np.array([len(p) for p in pieces])
    codes = np.zeros((len(pieces), size.max()), np.uint32)
    for k, p in enumerate(pieces):
        codes[k, :len(p)] = [ord(c) for c in p]
    key = substring_hash(prefix_sums(codes), np.zeros_like(size), size, np.arange(len(pieces)))
    order = np.argsort(key)
    if np.unique(key).size < key.size:
        raise ValueError("two pieces have one hash")
    score = np.array([sp.get_score(i) for i in plain])
    # What decoding writes for each id.
    data = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
    out = {
        "kind": np.array(kind), "key": key[order], "id": np.array(plain, np.int32)[order], "score": score[order], "longest": np.array(size.max()), "shelf": shelves(key[order]),
        "unknown": np.array(score[score > -1e8].min() - 10), "bytes": np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32),
        "data": np.frombuffer(b"".join(data), np.uint8), "at": np.concatenate([[0], np.cumsum([len(d) for d in data])]),
    }
    return out | (seams([pieces[k] for k in order], out["score"]) if kind == BPE else {})


def shelves(keys: np.ndarray) -> np.ndarray:
    """Where in the sorted keys each value of their upper bits begins; most shelves hold one key or none."""
    return np.searchsorted(keys >> np.uint64(64 - _BITS), np.arange((1 << _BITS) + 1, dtype=np.uint64)).astype(np.int32)


def found(keys: np.ndarray, shelf: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``wanted`` occur in the sorted ``keys``, and where)."""
    upper = (wanted >> np.uint64(64 - _BITS)).astype(np.int64)
    low, high = shelf[upper], shelf[upper + 1]
    left = np.flatnonzero(low < high)
    hits, places, at = [], [], low[left]
    while left.size:
        same = keys[at] == wanted[left]
        hits.append(left[same])
        places.append(at[same])
        at = at + 1
        more = ~same & (at < high[left])
        left, at = left[more], at[more]
    if len(hits) == 1:
        return hits[0], places[0]
    hit, place = np.concatenate(hits or [left]), np.concatenate(places or [at])
    order = np.argsort(hit)
    return hit[order], place[order]


def seams(pieces: list[str], score: np.ndarray) -> dict[str, np.ndarray]:
    """How merging builds each piece: its merges' scores in order, and the piece at either edge before each."""
    index = {p: k for k, p in enumerate(pieces)}
    deep = max(map(len, pieces))
    out = {"whole": np.zeros(len(pieces), bool), "step": np.full((len(pieces), deep), -np.inf), "left": np.full((len(pieces), deep), -1, np.int32), "right": np.full((len(pieces), deep), -1, np.int32)}
    for k, text in enumerate(pieces):
        parts = list(text)
        for t in range(deep):
            out["left"][k, t:], out["right"][k, t:] = index.get(parts[0], -1), index.get(parts[-1], -1)
            options = [(score[index[a + b]], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in index]
            if not options:
                break
            out["step"][k, t], i = max(options)
            parts[-i:2 - i] = [parts[-i] + parts[1 - i]]
        out["whole"][k] = len(parts) == 1
    merges = {(index[p[:i]], index[p[i:]]): score[k] for k, p in enumerate(pieces) for i in range(1, len(p)) if p[:i] in index and p[i:] in index}
    key = K.mix(np.array([a * len(pieces) + b for a, b in merges], np.uint64))
    order = np.argsort(key)
    return out | {"merge": key[order], "merge_score": np.array(list(merges.values()))[order], "merge_shelf": shelves(key[order])}


def may_follow(before: np.ndarray, piece: np.ndarray, model: dict) -> np.ndarray:
    """Whether merging the joint text of two pieces yields just them.

    Both sides merge on, the greater score first and the left one on a tie; a
    merge over the seam that comes before the next one on either side forbids.
    """
    n = model["whole"].size
    ok = np.ones(before.size, bool)
    at = np.flatnonzero(before >= 0)
    a, b = before[at].astype(np.int64), piece[at].astype(np.int64)
    i, j = np.zeros(at.size, np.int64), np.zeros(at.size, np.int64)
    while at.size:
        left, right = model["step"][a, i], model["step"][b, j]
        x, y = model["right"][a, i].astype(np.int64), model["left"][b, j].astype(np.int64)
        over = np.full(at.size, -np.inf)
        hit, place = found(model["merge"], model["merge_shelf"], K.mix((x * n + y).astype(np.uint64)))
        over[hit] = np.where((x[hit] >= 0) & (y[hit] >= 0), model["merge_score"][place], -np.inf)
        bad = (over > left) & (over >= right)
        ok[at[bad]] = False
        first = left >= right
        go = ~bad & ((left > -np.inf) | (right > -np.inf))
        i, j = (i + first)[go], (j + ~first)[go]
        at, a, b = at[go], a[go], b[go]
    return ok


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Rabin-Karp prefix sums along each row."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    np.cumsum(K.mix(codes.astype(np.uint64) + K.U64(1)) * K.powers(K.BASE, codes.shape[1]), axis=1, out=out[:, 1:])
    return out


def substring_hash(sums: np.ndarray, start, end, row=slice(None)) -> np.ndarray:
    return K.mix((sums[row, end] - sums[row, start]) * K.powers(K.INVERSE, sums.shape[1])[start])


def best_pieces(codes: np.ndarray, length: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Viterbi over words sorted by falling length: (word, end position, piece index or -1), in reading order."""
    n, longest = codes.shape
    merges = int(model["kind"]) == BPE
    sums = prefix_sums(codes)
    best = np.zeros((longest + 1, n))
    back, piece = np.zeros((longest + 1, n), np.int32), np.full((longest + 1, n), UNKNOWN, np.int32)
    piece[0] = START
    active = np.searchsorted(-length, -np.arange(longest + 1), "right")
    for end in range(1, longest + 1):
        size = np.arange(min(int(model["longest"]), end), 0, -1)
        rows = active[end]
        key = K.mix((sums[:rows, end, None] - sums[:rows, end - size]) * K.powers(K.INVERSE, longest + 1)[end - size])
        hit, at = found(model["key"], model["shelf"], key.ravel())
        row, which = np.divmod(hit, size.size)
        begin = end - size[which]
        if merges:
            # Exactly one candidate may follow, mostly the longest; a symbol without a piece follows anything.
            score = np.full(row.size, -np.inf)
            left = np.flatnonzero(model["whole"][at])
            while left.size:
                lead = np.ones(left.size, bool)
                lead[1:] = row[left[1:]] != row[left[:-1]]
                test, rest = left[lead], left[~lead]
                good = may_follow(piece[begin[test], row[test]], at[test], model)
                score[test[good]] = 0.0
                done = np.zeros(rows, bool)
                done[row[test[good]]] = True
                left = rest[~done[row[rest]]]
            unknown = np.full(rows, -1.0)
        else:
            score = best[begin, row] + model["score"][at]
            unknown = best[end - 1, :rows] + model["unknown"]
            unknown[row[size[which] == 1]] = -np.inf
        table, chosen = np.full((rows, size.size + 1), -np.inf), np.full((rows, size.size + 1), UNKNOWN)
        table[row, which], chosen[row, which] = score, at
        table[:, -1] = unknown
        top = table.argmax(axis=1)  # the longest piece of the best
        all_rows = np.arange(rows)
        piece[end, :rows] = chosen[all_rows, top]
        back[end, :rows] = end - np.append(size, 1)[top]
        best[end, :rows] = 0.0 if merges else table[all_rows, top]
    row, place, out = np.arange(n), length.astype(np.int32), []
    while row.size:
        out.append((row, place, piece[place, row]))
        place = back[place, row]
        row, place = row[place > 0], place[place > 0]
    row, place, which = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((place, row))
    return row[order], place[order], which[order]


def segmented(words: list[str], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of a list of different words, all not empty."""
    size = np.array([len(w) for w in words], np.int64)
    codes = np.append(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.uint32(0))
    begin = np.cumsum(size) - size
    owners, values = [], []
    order = np.argsort(-size, kind="stable")
    at = 0
    while at < order.size:
        # Words of one length, and the shorter ones that a bounded table also holds.
        longest = int(size[order[at]])
        end = at + int(np.searchsorted(-size[order[at:at + (1 << 18) // (longest + 1) + 1]], -(longest // 2), "right" if longest < 24 else "left"))
        part = order[at:max(end, at + 1)]
        at += part.size
        length = size[part]
        place = np.minimum(np.arange(longest), length[:, None] - 1)
        row, place, which = best_pieces(codes[begin[part][:, None] + place], length, model)
        ids, owner = np.where(which >= 0, model["id"][which], -1), part[row]
        if (which < 0).any():
            raw = [chr(codes[begin[o] + p - 1]).encode() if w < 0 else b"" for o, p, w in zip(owner, place, which)]
            count = np.array([max(1, len(r)) for r in raw])
            ids, owner = np.repeat(ids, count), np.repeat(owner, count)
            ids[ids < 0] = model["bytes"][np.frombuffer(b"".join(raw), np.uint8)]
        owners.append(owner)
        values.append(ids)
    owner, ids = np.concatenate(owners), np.concatenate(values)
    order = np.argsort(owner, kind="stable")
    return ids[order].astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])


def encode(buf: np.ndarray, off: np.ndarray, model: dict, cache: K.WordCache) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of a batch of UTF-8 texts."""
    if not buf.size:
        return np.zeros(0, np.int32), np.zeros(off.size, np.int64)
    # U+2581 counts as a space; a space goes in front of each text that isn't empty.
    wide = np.flatnonzero((buf[:-2] == 0xE2) & (buf[1:-1] == 0x96) & (buf[2:] == 0x81)) if buf.size > 2 else np.zeros(0, np.int64)
    if wide.size:
        stay = np.ones(buf.size, bool)
        stay[wide + 1] = stay[wide + 2] = False
        buf = buf.copy()
        buf[wide] = 32
        off, buf = np.concatenate([[0], np.cumsum(K.totals(stay, off))]), buf[stay]
    full = np.diff(off) > 0
    buf = np.insert(buf, off[:-1][full], np.uint8(32))
    off = off + np.concatenate([[0], np.cumsum(full)])
    space = buf == 32
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[off[:-1][full]] = True
    start = np.flatnonzero(start)
    end = np.append(start[1:], buf.size)
    data = buf.tobytes()

    def compute(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return segmented([data[a:b].decode().replace(" ", SPACE) for a, b in zip(start[places].tolist(), end[places].tolist())], model)

    ids, at = cache.lookup(K.window_hash(K.prefix(K.byte_units(buf)), start, end), compute)
    return ids, at[np.searchsorted(start, off)]


def decode(ids: np.ndarray, off: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a batch of id lists; the space put in front goes."""
    at = model["at"]
    count = (at[1:] - at[:-1])[ids]
    _, place = K.ragged(at[ids], count)
    out = model["data"][place]
    off = np.concatenate([[0], np.cumsum(count)])[off]
    lead = off[:-1][np.diff(off) > 0]
    lead = lead[out[lead] == 32]
    stay = np.ones(out.size, bool)
    stay[lead] = False
    return out[stay], np.concatenate([[0], np.cumsum(stay)])[off]


def encoder(docs: DataFrame, path: str, slice_bytes: int = 1 << 21):
    """A column function: text to struct (ids, round_trip); round_trip: the ids decode to the text."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    state: dict = {}

    @F.arrow_udf("struct<ids:array<int>,round_trip:boolean>")
    def pieces(text: pa.Array) -> pa.Array:
        cache = state.setdefault("cache", K.WordCache())
        lists, same = [], []
        for part in K.slices(pa.RecordBatch.from_arrays([text], ["text"]), "text", slice_bytes):
            column = part.column(0)
            buf, off = K.flat(column)
            ids, at = encode(buf, off, shared.value, cache)
            back, to = decode(ids, at, shared.value)
            if np.array_equal(back, buf) and np.array_equal(to, off):
                same.append(np.ones(len(column), bool))
            else:
                same.append(np.array([bytes(back[a:b]) == bytes(buf[c:d]) for a, b, c, d in zip(to, to[1:], off, off[1:])], bool))
            lists.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids), mask=column.is_null() if column.null_count else None))
        ids = pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))
        return pa.StructArray.from_arrays([ids, pa.array(np.concatenate(same) if same else [], pa.bool_(), mask=text.is_null().to_numpy(zero_copy_only=False))], ["ids", "round_trip"])

    return pieces


def decoder(docs: DataFrame, path: str):
    """A column function: ids to text."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        size = np.array([len(x) if x is not None else 0 for x in ids.to_pylist()], np.int64)
        values = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        data, off = decode(values, np.concatenate([[0], np.cumsum(size)]), shared.value)
        raw = data.tobytes()
        return pa.array([raw[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(off[:-1].tolist(), off[1:].tolist(), ids.is_valid().to_pylist())], pa.string())

    return text


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Every row of ``docs`` with ``ids`` and ``round_trip``; columns of these names are replaced."""
    own = [c for c in docs.columns if c not in ("ids", "round_trip")]
    coded = docs.select(F.struct(*[docs[c] for c in own]).alias("row"), encoder(docs, path)(F.col("text")).alias("pieces"))
    return coded.select("row.*", "pieces.ids", "pieces.round_trip")
