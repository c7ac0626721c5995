"""Operator 7: byte-level BPE by a lazily determinised transducer, with a streaming decoder.

A byte sequence's BPE tokens have two properties: every prefix of the token list is the
encoding of the bytes it spells, and a list of tokens is an encoding exactly if every two
neighbours are the encoding of their joined bytes. So a nondeterministic transducer over
bytes can guess where the next token starts: a guess is a node of the vocabulary's byte trie
(the token begun) with the tokens before it; a guess that completes a token survives if the
token may follow its predecessor. For every position exactly one guess completes.

The machine is determinised as texts need it: a state is the set of live guesses, each with
its tokens that are not yet common to all. Tokens common to all guesses are emitted, so the
lookahead is bounded by the longest token. Transitions, neighbour tests and the encodings of
whole pre-tokens are remembered up to fixed bounds.

Decoding feeds the tokens' bytes in pieces to an incremental UTF-8 state machine.

Null or empty text: no ids, hashes of the empty string. Rows repeat as in the input; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
import re
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traveltiers.llm.common import map_batches, remember, table

#: Bounds of what a worker remembers: pre-tokens, transitions, neighbour tests.
MEMO_WORDS, MEMO_STEPS, MEMO_PAIRS = 400_000, 300_000, 500_000
DECODE_STEP = 8192
NEVER = 1 << 60
#: What a pattern's classes are among ASCII characters, for texts that have no others: there Python's own ``re`` splits alike and sooner.
_ASCII_FORMS = {
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+":
        r" ?[A-Za-z]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\sA-Za-z0-9]+| ?[0-9]+|\s+(?!\S)|\s+",
}


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank per line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Transducer:
    """Bytes of one pre-token in, token ids out."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.token = ranks, {i: t for t, i in ranks.items()}
        # The trie: node -> {byte: node}; node 0 is its root; `ends` has the token spelt by a node.
        self.child: list[dict[int, int]] = [{}]
        self.top = [0]  # the first byte of a node's path
        self.ends: dict[int, int] = {}
        for tok, i in ranks.items():
            node = 0
            for b in tok:
                if b not in self.child[node]:
                    self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.top.append(tok[0])
                node = self.child[node][b]
            self.ends[node] = i
        # Ranks of the merges that first take in a token's first and last byte, and of the byte pairs themselves.
        self.spine_of: dict[int, list] = {}
        self.first, self.last = {}, {}
        self.entire: dict[int, bool] = {}  # whether a token is the encoding of its own bytes
        for tok, i in ranks.items():
            left, right = self.spines(tok)
            if any(x[1] >= y[1] for s in (left, right) for x, y in zip(s, s[1:])):
                raise ValueError("a merge comes before the merges of its parts")
            self.first[i], self.last[i] = left[0][1], right[0][1]
            self.entire[i] = len(left[-1][0]) == len(tok)
        self.byte_pair = {t[0] << 8 | t[1]: i for t, i in ranks.items() if len(t) == 2}
        # For every node, the earliest such merge of a token at or below it.
        self.soonest = [self.first[self.ends[n]] if n in self.ends else NEVER for n in range(len(self.child))]
        for n in range(len(self.child) - 1, -1, -1):  # children have higher numbers
            for c in self.child[n].values():
                self.soonest[n] = min(self.soonest[n], self.soonest[c])
        self.border = {i: t[-1] << 8 for t, i in ranks.items()}  # the upper half of the byte pair at a token's end
        self.pairs: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        """Start the deterministic machine anew."""
        start = (-1, ((0, ()),))
        self.number, self.states = {start: 0}, [start]
        self.steps: dict[int, tuple[int, tuple]] = {}

    def merges(self, data: bytes):
        """The definition: again and again join the neighbours of lowest rank; yields (rank, index, parts)."""
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = [self.ranks.get(parts[i] + parts[i + 1], NEVER) for i in range(len(parts) - 1)]
        while ranks and (rank := min(ranks)) < NEVER:
            i = ranks.index(rank)
            yield rank, i, parts
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = self.ranks.get(parts[i - 1] + parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = self.ranks.get(parts[i] + parts[i + 1], NEVER)
        yield NEVER, -1, parts

    def merged(self, data: bytes) -> list[int]:
        """The encoding by its definition."""
        for _, _, parts in self.merges(data):
            pass
        return [self.ranks[p] for p in parts]

    def spines(self, tok: bytes) -> tuple[list, list]:
        """The pieces that held a token's first and its last byte while it was merged, each with the rank that took it."""
        left, right = [], []
        for rank, i, parts in self.merges(tok):
            if i == 0 or i < 0:
                left.append((parts[0], rank))
            if i < 0 or i == len(parts) - 2:
                right.append((parts[-1], rank))
        return left, right

    def spine(self, token: int, side: int) -> list:
        key = token << 1 | side
        if key not in self.spine_of:
            self.spine_of[token << 1], self.spine_of[token << 1 | 1] = self.spines(self.token[token])
        return self.spine_of[key]

    def apart(self, left: int, right: int) -> bool:
        """Whether no merge ever crosses the border of two tokens: both sides are replayed in the order of their merges."""
        a, b, i, j = self.spine(left, 1), self.spine(right, 0), 0, 0
        while True:
            (x, until), (y, end) = a[i], b[j]
            m = self.ranks.get(x + y, NEVER)
            if m < until and m <= end:  # of equal ranks the leftmost pair goes first
                return False
            if until == end == NEVER:
                return True
            if until <= end:
                i += 1
            else:
                j += 1

    def follows(self, left: int, right: int) -> bool:
        """Whether token ``right`` may stand after ``left`` (-1: at the start)."""
        key = left << 20 | right if left >= 0 else ~right
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            got = self.pairs[key] = self.entire[right] and (left < 0 or self.entire[left] and self.apart(left, right))
        return got

    def step(self, state: int, byte: int) -> tuple[int, tuple]:
        """Next state and the tokens emitted; made once."""
        before, guesses = self.states[state]
        child, ends, byte_pair = self.child, self.ends, self.byte_pair
        done, live = None, []
        for node, path in guesses:
            nxt = child[node].get(byte)
            if nxt is None:
                continue
            prev = path[-1] if path else before
            if done is None and nxt in ends and self.follows(prev, ends[nxt]):
                done = path + (ends[nxt],)
            if child[nxt]:
                # A guess is dropped once no token at or below its node could stand after its predecessor: the bytes at the
                # border merge before either side could take its own.
                m = byte_pair.get(self.border[prev] | self.top[nxt]) if prev >= 0 else None
                if m is None or m >= self.soonest[nxt] or m >= self.last[prev]:
                    live.append((nxt, path))
        if done is None:
            raise ValueError("the ranks are no byte-level BPE: no token can end here")
        common = len(done)
        for _, path in live:
            k, common = common, 0
            while common < k and common < len(path) and path[common] == done[common]:
                common += 1
            if not common:
                break
        live.append((0, done))
        out = done[:common]
        last = out[-1] if out else before
        rest = tuple([(n, p[common:]) for n, p in live]) if common else tuple(live)
        new = (-1 if all([p for _, p in rest]) else last, rest)
        number = self.number.get(new)
        if number is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
        self.steps[state << 8 | byte] = got = (number, out)
        return got

    def encode(self, data: bytes) -> tuple[int, ...]:
        if len(self.steps) > MEMO_STEPS:
            self.forget()
        state, out, steps = 0, [], self.steps
        for b in data:
            got = steps.get(state << 8 | b)
            if got is None:
                if len(steps) > 2 * MEMO_STEPS:  # within one very long pre-token: keep only the current state
                    now = self.states[state]
                    self.forget()
                    steps, state = self.steps, self.number.setdefault(now, 1)
                    if state:
                        self.states.append(now)
                got = self.step(state, b)
            state, emitted = got
            if emitted:
                out += emitted
        out += self.states[state][1][-1][1]
        return tuple(out)


class Memo(dict):
    """Encodings of pre-tokens; a missing one goes through the machine, and is kept unless it is long."""

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine = machine

    def __missing__(self, pre: str) -> tuple[int, ...]:
        ids = self.machine.encode(pre.encode())
        if len(pre) <= 64:
            self[pre] = ids
        return ids


class Codec:
    """Encoder and decoder of whole texts."""

    def __init__(self, ranks_file: bytes, pattern: str):
        import regex

        self.machine = Transducer(read_ranks(ranks_file))
        self.split = regex.compile(pattern)
        self.split_ascii = re.compile(_ASCII_FORMS[pattern], re.ASCII) if pattern in _ASCII_FORMS else self.split
        self.memo = Memo(self.machine)
        size = 1 + max(self.machine.token)
        self.bytes = [self.machine.token.get(i, b"") for i in range(size)]
        self.text = [str(i) for i in range(size)]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text: each match of the pattern by itself."""
        if not text:
            return []
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        split = self.split_ascii if text.isascii() else self.split
        return list(chain.from_iterable(map(self.memo.__getitem__, split.findall(text))))

    def decode(self, ids: list[int]):
        """Pieces (bytes, text) of the decoded ids; a code point that two tokens share comes with the later one."""
        utf8 = codecs.getincrementaldecoder("utf-8")()
        for i in range(0, len(ids), DECODE_STEP):
            data = b"".join(map(self.bytes.__getitem__, ids[i:i + DECODE_STEP]))
            yield data, utf8.decode(data, i + DECODE_STEP >= len(ids))

    def digest(self, ids: list[int]) -> tuple[str, str]:
        """Hashes of the decimal ids and of the decoded bytes."""
        said, whole = hashlib.sha256(), hashlib.sha256()
        said.update(" ".join(map(self.text.__getitem__, ids)).encode())
        for data, _ in self.decode(ids):
            whole.update(data)
        return said.hexdigest(), whole.hexdigest()


_codecs: dict[int, Codec] = {}
remember(__name__, _codecs)


def codec(ranks_file: bytes, pattern: str) -> Codec:
    """One codec a worker process and vocabulary, kept between tasks."""
    key = hash((ranks_file, pattern))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks_file, pattern)
        gc.freeze()  # what is remembered holds no cycles; the collector need not walk it again and again
        gc.set_threshold(200_000, 20, 100)
    return _codecs[key]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256, and with ``with_ids`` the ids. The rank file is broadcast (its size is the vocabulary's)."""
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    named = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))

    def run(cols: dict, own: Codec) -> dict:
        out: dict = {"k": cols["k"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        if with_ids:
            out["ids"] = []
        for t in cols["t"]:
            ids = own.encode(t)
            said, whole = own.digest(ids)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(said)
            out["decoded_sha256"].append(whole)
            if with_ids:
                out["ids"].append(ids)
        return out

    kind = named.schema["k"].dataType.simpleString()
    schema = f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    out = map_batches(named, run, schema, lambda: codec(ranks.value, pattern))
    return out.withColumnRenamed("k", key)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return encode_decode(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
