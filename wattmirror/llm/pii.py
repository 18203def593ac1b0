"""Personal data in texts: fixed rules for e-mail, ip, card and phone, widened by a character BiLSTM-CRF.

The tagger is trained in numpy from labelled spans: what the rules find in a bounded sample of windows, with the values
also rewritten in forms the rules do not know. Every span of the four kinds holds a digit or an @, so a decoded span without one is never valid. Windows therefore run, overlapping by half, over all of the text near such
characters, and over the whole stretch that a span with them could take; elsewhere there is nothing that decoding
could yield. Windows vote per character: their tag probabilities are averaged, those far from a border counting more.
Spans come from single windows and from the averages, so that they may be longer than a window, and all are weighted
by the averages. They are reconciled over the whole document: rule spans stay, then the heaviest set of tagger spans
that do not overlap.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmirror.llm.bilstm import PAD, Tagger, classes_of
from wattmirror.llm.common import map_texts, packed, unpacked

KINDS = ["email", "ip", "card", "phone"]
LENGTH = 48                    # characters of a window; windows start every half length
SAMPLE_WINDOWS = 3_000         # the most labelled windows the tagger is trained on
HIDDEN, STEPS, BATCH, RATE, SEED = 12, 220, 64, 0.03, 7
LEAST_SCORE = 0.8              # mean tag probability a tagger span needs
PLACEHOLDER = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

# Fixed patterns of the contract.
LOCAL_SIGN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NUMERIC = re.compile(r"[0-9(][\x20().0-9-]*")
SPACE = re.compile(r"\s")
LOCAL_PHONE = re.compile(r"\(?[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]    # kind, start, end


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _card_ok(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and _luhn(digits)


def _ip_ok(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """Rule spans, ordered by kind and start; leftmost and not overlapping within a kind, in linear time."""
    found: list[Span] = []
    at, over = text.find("@"), 0
    while at >= 0:
        start = at
        while start > over and text[start - 1] in LOCAL_SIGN:
            start -= 1
        over_now = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append((0, start, m.end()))
            over_now = m.end()
        over = over_now
        at = text.find("@", over)
    if not DIGIT.search(text):
        return found
    for m in NUMBERS.finditer(text):
        parts = m.group().split(".")
        start = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = ".".join(parts[i:i + 4])
            if _ip_ok(four):
                found.append((1, start, start + len(four)))
            start += len(four) + 1
    found += [(2, m.start(), m.end()) for m in CARD.finditer(text) if _card_ok(m.group())]
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return found


def _stretches(text: str) -> list[tuple[int, int]]:
    """Where spans can lie: what stands between white space around an @, and digits with signs between them."""
    found, at = [], text.find("@")
    while at >= 0:
        start, least = at, found[-1][1] if found else 0
        while start > least and not text[start - 1].isspace():
            start -= 1
        space = SPACE.search(text, at)
        found.append((start, space.start() if space else len(text)))
        at = text.find("@", found[-1][1])
    for m in NUMERIC.finditer(text):
        own = m.group().rstrip(" ().-")
        if own:
            found.append((m.start(), m.start() + len(own)))
    return sorted(found)


def _starts(text: str) -> list[int]:
    """Starts of the overlapping windows that cover every stretch with a digit or an @."""
    half, starts, last = LENGTH // 2, [], -1
    for a, b in _stretches(text):
        for k in range(max(last + 1, a // half - 1), (b - 1) // half + 1):
            starts.append(k * half)
            last = k
    return starts


def _tags(spans: list[Span], start: int) -> np.ndarray:
    tags = np.zeros(LENGTH, dtype=np.int8)
    for kind, a, b in spans:
        lo, hi = max(a - start, 0), min(b - start, LENGTH)
        if lo < hi and not tags[lo:hi].any():
            tags[lo:hi] = 2 + 2 * kind
            if a >= start:
                tags[lo] = 1 + 2 * kind
    return tags


def _window(text: str, start: int) -> np.ndarray:
    x = np.full(LENGTH, PAD, dtype=np.int8)
    part = classes_of(text[start:start + LENGTH])
    x[:part.size] = part
    return x


def spellings(kind: int, text: str) -> list[str]:
    """Forms of a value that no rule finds: set apart, bracketed, with other signs, without country code."""
    if kind == 0:
        name, domain = text.split("@")
        return [f"{name} @ {domain}", f"{name}[@]{domain}", f"{name}@{domain.replace('.', '[.]')}", f"{name}@{domain.replace('.', ' . ')}"]
    if kind == 1:
        return [text.replace(".", "[.]"), text.replace(".", " . "), text.replace(".", "-"), text.replace(".", "(.)")]
    digits = _digits(text)
    if kind == 2:
        fours = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [".".join(fours), "/".join(fours), "  ".join(fours), "_".join(fours)]
    area, mid, rest = digits[-10:-7], digits[-7:-4], digits[-4:]
    return [f"({area}) {mid}-{rest}", f"{area}-{mid}-{rest}", f"{area}.{mid}.{rest}", f"({area}) {mid} {rest}",
            f"{area} {mid} {rest}"] if len(digits[-10:]) >= 9 else []


def respelled(text: str, spans: list[Span]) -> tuple[str, list[Span]] | None:
    """The text with its values in forms that the rules do not know, and where these stand."""
    parts, marked, at, size = [], [], 0, 0
    for i, (kind, a, b) in enumerate(sorted(spans, key=lambda s: (s[1], -s[2]))):
        forms = spellings(kind, text[a:b]) if a >= at else []
        if forms:
            form = forms[(a + i) % len(forms)]
            parts += [text[at:a], form]
            size += a - at
            marked.append((kind, size, size + len(form)))
            size, at = size + len(form), b
    return ("".join([*parts, text[at:]]), marked) if marked else None


def labelled_windows(docs: DataFrame) -> DataFrame:
    """(kinds, rank, x, y): every window near a digit or an @ with its classes and tags, rank a hash of the content."""
    def run(texts):
        rows = []
        for text in texts:
            spans = base_spans(text)
            variants = [(text, spans)]
            if (other := respelled(text, spans)):
                variants.append(other)
            for turn, (t, s) in enumerate(variants):
                by_start, ahead = sorted(s, key=lambda p: p[1]), 0
                open_: list[Span] = []                      # begun before the window's end and not over at its start
                for start in _starts(t):
                    while ahead < len(by_start) and by_start[ahead][1] < start + LENGTH:
                        open_.append(by_start[ahead])
                        ahead += 1
                    near = open_ = [p for p in open_ if p[2] > start]
                    if turn and not near:
                        continue
                    y = _tags(near, start)
                    x = _window(t, start)
                    rank = int.from_bytes(hashlib.blake2b(x.tobytes() + y.tobytes(), digest_size=7).digest(), "big")
                    rows.append((min((p[0] for p in near), default=4), rank, x.tobytes(), y.tobytes()))
        return rows

    def batches(it):
        from wattmirror.llm.common import chunks
        for _, texts in chunks(it):
            rows = run(texts)
            if rows:
                k, r, x, y = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(r, pa.int64()),
                                                  pa.array(x, pa.binary()), pa.array(y, pa.binary())],
                                                 ["kind", "rank", "x", "y"])

    return docs.select("text").mapInArrow(batches, "kind int, rank long, x binary, y binary")


def train(docs: DataFrame, windows: int = SAMPLE_WINDOWS) -> Tagger | None:
    """The tagger, from at most `windows` different labelled windows, as many of each kind as there are.

    The sample is the windows of least content hash, so it does not depend on partitions or row order.
    """
    from pyspark.sql import Window

    share = windows // (len(KINDS) + 1)
    spread = F.col("rank") % 64
    own = Window.partitionBy("kind", spread).orderBy("rank")
    picked = labelled_windows(docs).dropDuplicates(["kind", "rank"]) \
        .withColumn("nth", F.row_number().over(own)).where(F.col("nth") <= share)
    rows = picked.withColumn("n", F.row_number().over(Window.partitionBy("kind").orderBy("rank"))) \
        .where(F.col("n") <= share).orderBy("kind", "rank").select("x", "y").collect()
    if not rows:
        return None
    x = np.stack([np.frombuffer(bytes(r.x), dtype=np.int8) for r in rows])
    y = np.stack([np.frombuffer(bytes(r.y), dtype=np.int8) for r in rows])
    return Tagger.fresh(2 * len(KINDS) + 1, HIDDEN, SEED).fit(x, y, STEPS, BATCH, RATE, SEED)


BRACKETED = re.compile(r"\[([@.])\]|\((\.)\)|\x20([@.])\x20")
OTHER_CARD = re.compile(r"[0-9](?:(?:[ ./_-]|\x20\x20)?[0-9])+")


def _plain(text: str) -> str:
    """The value without brackets and spaces around its signs."""
    return BRACKETED.sub(lambda m: m[1] or m[2] or m[3], text)


def _plausible(kind: int, text: str) -> bool:
    if kind == 0:
        name, at, domain = _plain(text).partition("@")
        return bool(at and name.strip() and "." in domain.strip(".") and not re.search(r"\s", name + domain))
    if kind == 1:
        own = _plain(text)
        own = own.replace("-", ".") if "." not in own else own
        return bool(re.fullmatch(r"[0-9.]+", own)) and _ip_ok(own)
    if kind == 2:
        return bool(OTHER_CARD.fullmatch(text)) and _card_ok(text)
    if not LOCAL_PHONE.fullmatch(text) or not 9 <= len(_digits(text)) <= 15:
        return False
    return bool(re.fullmatch(r"[0-9]{3}\.[0-9]{3}\.[0-9]{4}", text)) or bool(
        not NUMBERS.fullmatch(text) and not re.fullmatch(r"[0-9]{4}(?:[ -][0-9]{4})+", text))


def _decode(starts: list[int], path: np.ndarray) -> set[Span]:
    """Spans on the best paths of single windows; those cut off at a border are left to `_voted`."""
    found: set[Span] = set()
    for w, start in enumerate(starts):
        tags = path[:, w]
        t = 0
        while t < LENGTH:
            if tags[t] % 2 == 1:
                end = t + 1
                while end < LENGTH and tags[end] == tags[t] + 1:
                    end += 1
                if end < LENGTH:
                    found.add((int(tags[t]) // 2, start + t, start + end))
                t = end
            else:
                t += 1
    return found


WEIGHT = np.minimum(np.arange(1, LENGTH + 1), np.arange(LENGTH, 0, -1)).astype(np.float32)


class Votes:
    """Per run of windows half a length apart: its start and the average tag probabilities of its characters.

    Windows come in order, a few at a time. Only sums per character are held.
    """

    def __init__(self):
        self.runs: list[tuple[int, list[np.ndarray]]] = []
        self.next = -1                     # where the next window begins if it goes on with the last run

    def add(self, starts: np.ndarray, chance: np.ndarray) -> None:
        half = LENGTH // 2
        weighted = (chance * WEIGHT[:, None, None]).transpose(1, 0, 2)
        for own in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(starts) != half) + 1):
            total = np.zeros((own.size + 1, half, chance.shape[2]), dtype=np.float32)
            total[:-1] += weighted[own, :half]
            total[1:] += weighted[own, half:]
            if starts[own[0]] == self.next:
                self.runs[-1][1][-1][-1] += total[0]
                self.runs[-1][1].append(total[1:])
            else:
                self.runs.append((int(starts[own[0]]), [total]))
            self.next = int(starts[own[-1]]) + half

    def means(self) -> list[tuple[int, np.ndarray]]:
        out = []
        for start, parts in self.runs:
            mean = np.concatenate(parts)
            parts.clear()
            mean /= mean.sum(axis=2, keepdims=True)
            out.append((start, mean.reshape(-1, mean.shape[2])))
        return out


def _voted(start: int, mean: np.ndarray, size: int) -> list[Span]:
    """Spans on the averages: runs of one kind, cut where a beginning is likelier than an inner character."""
    first, inner = mean[:, 1::2], mean[:, 2::2]
    kinds = np.concatenate([mean[:, :1], first + inner], axis=1).argmax(axis=1)
    new = kinds[1:] != kinds[:-1]
    at = np.arange(1, len(kinds))
    new |= (kinds[1:] > 0) & (mean[at, 2 * kinds[1:] - 1] > mean[at, 2 * kinds[1:]])
    begin = np.concatenate([[0], np.flatnonzero(new) + 1])
    end = np.append(begin[1:], len(kinds))
    return [(int(kinds[a]) - 1, start + a, min(start + b, size)) for a, b in zip(begin.tolist(), end.tolist())
            if kinds[a] and (b < len(kinds) or start + b >= size) and start + a < size]


def _candidates(text: str, votes: list[tuple[int, np.ndarray]], proposed: set[Span]) -> list[tuple[float, Span]]:
    """Proposed spans and those of the averages, weighted by mean average probability of their tags."""
    begins = [start for start, _ in votes]
    spans = proposed.union(*[_voted(start, mean, len(text)) for start, mean in votes])
    out = []
    for kind, a, b in spans:
        start, mean = votes[bisect.bisect_right(begins, a) - 1]
        p = mean[a - start, 1 + 2 * kind] + mean[a + 1 - start:b - start, 2 + 2 * kind].sum()
        out.append((float(p) / (b - a), (kind, a, b)))
    return out


def _reconcile(text: str, base: list[Span], candidates: list[tuple[float, Span]]) -> list[Span]:
    """The heaviest set of candidates that overlap neither each other nor a rule span (weighted intervals).

    Rule spans may overlap each other, those of other kinds; united, they are looked up by bisection, as are earlier
    candidates. A link per candidate leads to the best set that ends before it.
    """
    taken: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    begins = [a for a, _ in taken]
    free = []
    for p, (kind, a, b) in candidates:
        if p < LEAST_SCORE or (a and text[a - 1].isalnum()) or text[b:b + 1].isalnum():
            continue
        before = bisect.bisect_left(begins, b) - 1           # the last rule span that begins before the end
        if (before < 0 or taken[before][1] <= a) and _plausible(kind, text[a:b]):
            free.append((b, a, kind, p * (b - a)))
    free.sort()
    ends = [-1]
    weight, chosen, link = [0.0], [-1], [0]                  # of the best set among the first candidates
    for i, (b, a, _, own) in enumerate(free):
        before = bisect.bisect_right(ends, a) - 1
        with_it = weight[before] + own
        better = with_it > weight[-1]
        weight.append(with_it if better else weight[-1])
        chosen.append(i if better else chosen[-1])
        link.append(before if better else link[-1])
        ends.append(b)
    out, at = [], len(free)
    while chosen[at] >= 0:
        b, a, kind, _ = free[chosen[at]]
        out.append((kind, a, b))
        at = link[at]
    return out[::-1]


def find_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Per text: the rule spans and all spans, each ordered by kind and start."""
    base = [base_spans(t) for t in texts]
    starts = [_starts(t) if tagger else [] for t in texts]
    owners = [(i, s) for i, own in enumerate(starts) for s in own]
    added: dict[int, list[tuple[float, Span]]] = {}
    votes, proposed = Votes(), set()
    for at in range(0, len(owners), 2048):
        part = owners[at:at + 2048]
        x = np.stack([_window(texts[i], s) for i, s in part]).T.astype(np.int64)
        chance, path = tagger.marginals(x)
        col = 0
        while col < len(part):
            end = col
            while end < len(part) and part[end][0] == part[col][0]:
                end += 1
            i = part[col][0]
            votes.add(np.array([s for _, s in part[col:end]]), chance[:, col:end].astype(np.float32))
            proposed |= _decode([s for _, s in part[col:end]], path[:, col:end])
            if part[end - 1][1] == starts[i][-1]:                                # all windows of the text are there
                added[i] = _candidates(texts[i], votes.means(), proposed)
                votes, proposed = Votes(), set()
            col = end
    out = []
    for i, text in enumerate(texts):
        extra = _reconcile(text, base[i], added[i]) if i in added else []
        out.append((base[i], sorted(base[i] + extra)))
    return out


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, tagger: Tagger | None, keep: list[str]) -> DataFrame:
    """The kept columns with `base_spans` and `spans`: kind:start:end, comma-joined, in code points, end exclusive.

    Null and empty texts have no spans. Nothing depends on other rows, so repeated rows give repeated results. An
    empty table, or one without any window to learn from, is handled by the rules alone (tagger None).
    """
    def work(texts):
        found = find_spans(texts, tagger)
        return [[_listed(b) for b, _ in found], [_listed(s) for _, s in found]]

    return map_texts(docs, keep, "base_spans string, spans string", work)


def redact(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlapping spans become one, named by the
    first. n_chars, if there, follows the text; a null text stays null. Other columns pass, whatever their names."""
    def work(texts):
        out = []
        for text, (_, spans) in zip(texts, find_spans(texts, tagger)):
            parts, at = [], 0
            for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
                if a >= at:
                    parts += [text[at:a], PLACEHOLDER[KINDS[kind]]]
                at = max(at, b)
            out.append("".join(parts) + text[at:] if parts else text)
        return [out]

    own = ["text", "n_chars"]
    held = packed(docs, own)
    redone = map_texts(held, held.columns, "redacted string", work) \
        .withColumn("text", F.when(F.col("text").isNotNull(), F.col("redacted")))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        redone = redone.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind))
                                   .otherwise(F.col("n_chars")))
    return unpacked(redone, docs.columns, own)
