"""Personal data: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The field labels the white-space separated words of a line. Its features are word shapes (runs of letters,
runs of digits with their length, punctuation) of a word and its two neighbours. It is trained from a
small labelled table by gradient steps on the exact likelihood, and decoded by Viterbi in numpy over many
lines at once. Lines whose words cannot, by a bound on the weights, leave the label "outside" are settled
by that bound. Every added span must pass its kind's arithmetic check.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.pii_labels import LABELLED
from storelake.llm.shared import count_kinds, slices, spans_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
MAX_TRAIN = 5_000  # Labelled sentences; the table is small by definition.
_TOKENS = 400_000  # Words decoded at once.
_SHAPES = 200_000  # Words remembered with their shape, per task.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# The look-behind keeps a long run of digits from being tried at each of its digits.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, str, int]  # Start, rank of the kind, kind, end.


# --- fixed patterns ---------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost without overlap in each kind; a match that fails its check is dropped."""
    out = [(s, 0, "email", e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), 1, "ip", m.end()) for m in _IP.finditer(text)
                if all(len(p) < 4 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, "card", m.end()))
        out += [(m.start(), 3, "phone", m.end()) for m in _PHONE.finditer(text)
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


# --- word shapes ------------------------------------------------------------------------------

_RUNS = re.compile(r"([0-9]+)|([^\W\d_]+)|(.)", re.S)


def shape(word: str) -> str:
    """Runs of digits as D and their length, of letters as a, A or Aa, (at) and (dot) as
    they are; repeated marks once."""
    if word.isalpha():
        return "a" if word.islower() else "A" if word.isupper() else "Aa"
    out: list[str] = []
    for m in _RUNS.finditer(word):
        if m[1]:
            out.append(f"D{min(len(m[1]), 20)}")
        elif m[2] in ("at", "dot") and out and out[-1] in "([":
            out.append(m[2])  # How addresses are spelled out.
        elif m[2]:
            out.append("a" if m[2].islower() else "A" if m[2].isupper() else "Aa")
        elif not out or out[-1] != m[3]:
            out.append(m[3])
    return "".join(out)


def shape_features(form: str) -> list[str]:
    core = form.rstrip(".,;:!?\"'")
    digits = sum(map(int, re.findall(r"D(\d+)", form)))
    size = digits if digits < 5 else 5 if digits < 7 else 7 if digits < 10 else 10 if digits < 13 else 13
    kinds = "".join(sorted(set(re.sub(r"D\d+", "D", core))))
    return [f"s={core}", f"n={size}", f"k={kinds}", f"f={core[:1]}", f"t={form[len(core):][:1]}", "bias",
            f"at={'@' in form}", f"dots={min(len(re.findall(r'D[0-9]+[.]', core)), 4)}"]


EDGE = ["edge"]


# --- the field --------------------------------------------------------------------------------


def _allowed() -> np.ndarray:
    """0 where a label may follow another, very low where an inside label would lack its beginning."""
    out = np.zeros((len(LABELS) + 1, len(LABELS)))
    for j, after in enumerate(LABELS):
        if after.startswith("I-"):
            for i, before in enumerate(LABELS):
                if before[2:] != after[2:]:
                    out[i, j] = -1e4
            out[-1, j] = -1e4  # At the start of a line.
    return out


@dataclass
class Field:
    """Weights by feature: of the word itself, as the word before, as the word after; and of label pairs."""
    index: dict[str, int]
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    steps: np.ndarray  # (labels + 1, labels): from each label, and from the start of a line.

    def vectors(self, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held = [self.index[f] for f in features if f in self.index]
        return self.own[held].sum(axis=0), self.before[held].sum(axis=0), self.after[held].sum(axis=0)

    @cached_property
    def slack(self) -> np.ndarray:
        """The most that label pairs can add for a word of each label but outside: on entry, and on leaving."""
        extra = self.steps - self.steps[0, 0]
        extra[-1] = self.steps[-1] - self.steps[-1, 0]
        return extra[:, 1:].max(axis=0) + np.maximum(extra[1:-1, 0], 0)


def read_labelled(marked: Sequence[str] = LABELLED) -> list[tuple[list[str], list[int]]]:
    """Words and labels of sentences with ``[kind|text]`` marks."""
    out = []
    for sentence in marked[:MAX_TRAIN]:
        words: list[str] = []
        labels: list[int] = []
        spans, plain, at = [], "", 0
        for m in re.finditer(r"\[(\w+)\|(.*?)\](?![\w ]*\[dot\])(?!\])", sentence):
            plain += sentence[at:m.start()]
            spans.append((len(plain), len(plain) + len(m[2]), m[1]))
            plain += m[2]
            at = m.end()
        plain += sentence[at:]
        for m in re.finditer(r"\S+", plain):
            hit = next((s for s in spans if s[0] < m.end() and m.start() < s[1]), None)
            words.append(m[0])
            labels.append(0 if hit is None else LABELS.index(("B-" if m.start() <= hit[0] else "I-") + hit[2]))
        out.append((words, labels))
    return out


def train(marked: Sequence[str] = LABELLED, rounds: int = 300, rate: float = 0.4, decay: float = 0.0005) -> Field:
    """Maximise the likelihood of the labelled sentences, with AdaGrad steps and weight decay; deterministic."""
    data = read_labelled(marked)
    n, longest, size = len(data), max(len(w) for w, _ in data), len(LABELS)
    index: dict[str, int] = {f: 0 for f in EDGE}
    forms = [[shape_features(shape(w)) for w in words] for words, _ in data]
    for sentence in forms:
        for features in sentence:
            for f in features:
                index.setdefault(f, len(index))
    x = np.zeros((n, longest + 2, len(index)))
    x[:, 0, 0] = 1
    gold = np.zeros((n, longest), int)
    mask = np.zeros((n, longest), bool)
    for i, (sentence, (_, labels)) in enumerate(zip(forms, data)):
        x[i, len(labels) + 1, 0] = 1
        gold[i, :len(labels)], mask[i, :len(labels)] = labels, True
        for t, features in enumerate(sentence):
            x[i, t + 1, [index[f] for f in features]] = 1
    flat = [np.ascontiguousarray(v).reshape(-1, len(index)) for v in (x[:, 1:-1], x[:, :-2], x[:, 2:])]
    fixed = _allowed()
    params = [np.zeros((len(index), size)) for _ in flat] + [np.zeros((size + 1, size))]
    scale = [np.full_like(p, 1e-6) for p in params]
    truth = np.eye(size)[gold] * mask[:, :, None]
    true_steps = np.zeros((size + 1, size))
    for i, (_, labels) in enumerate(data):
        for a, b in zip([size, *labels], labels):
            true_steps[a, b] += 1
    for _ in range(rounds):
        emit = sum(v @ p for v, p in zip(flat, params[:3])).reshape(n, longest, size)
        steps = params[3] + fixed
        alpha = np.zeros((n, longest, size))
        beta = np.zeros((n, longest, size))
        alpha[:, 0] = steps[-1] + emit[:, 0]
        for t in range(1, longest):
            into = np.logaddexp.reduce(alpha[:, t - 1, :, None] + steps[None, :-1], axis=1)
            alpha[:, t] = np.where(mask[:, t, None], into + emit[:, t], alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            back = np.logaddexp.reduce(steps[None, :-1] + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(mask[:, t + 1, None], back, 0)
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        share = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
        seen = np.zeros_like(steps)
        seen[-1] = share[:, 0].sum(axis=0)
        for t in range(1, longest):
            joint = alpha[:, t - 1, :, None] + steps[None, :-1] + (emit[:, t] + beta[:, t])[:, None, :]
            seen[:-1] += (np.exp(joint - total[:, None, None]) * mask[:, t, None, None]).sum(axis=0)
        rest = truth - share
        grads = [v.T @ rest.reshape(-1, size) for v in flat] + [true_steps - seen]
        for p, s, g in zip(params, scale, grads):
            g -= decay * n * p
            s += g * g
            p += rate * g / np.sqrt(s)
    return Field(index, params[0], params[1], params[2], params[3] + fixed)


class _Shapes(dict[str, int]):
    """Word to number of its shape; each shape's weights are worked out once."""

    def __init__(self, field: Field):
        super().__init__()
        self.field, self.forms = field, {}
        self.own, self.before, self.after = ([v] for v in field.vectors(EDGE))
        self.tables: tuple[np.ndarray, ...] = ()

    def __missing__(self, word: str) -> int:
        form = shape(word)
        number = self.forms.get(form)
        if number is None:
            number = self.forms[form] = len(self.own)
            for table, vector in zip((self.own, self.before, self.after), self.field.vectors(shape_features(form))):
                table.append(vector)
        self[word] = number
        return number

    def arrays(self) -> tuple[np.ndarray, ...]:
        if not self.tables or len(self.tables[0]) != len(self.own):
            self.tables = np.array(self.own), np.array(self.before), np.array(self.after)
        return self.tables


def viterbi(emit: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best labels of padded lines (line, word, label), longest first; ties go to the earlier label."""
    n, longest, size = emit.shape
    score = steps[-1] + emit[:, 0]
    back = np.zeros((n, longest, size), np.uint8)
    for t in range(1, longest):
        live = int(np.searchsorted(-lengths, -t, side="left"))  # Lines with more than t words.
        paths = score[:live, :, None] + steps[None, :-1]
        back[:live, t] = paths.argmax(axis=1)
        score[:live] = paths.max(axis=1) + emit[:live, t]
    out = np.zeros((n, longest), np.int64)
    label = score.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        inside = lengths > t
        out[inside, t] = label[inside]
        if t:
            label = np.where(inside, back[np.arange(n), t, label], label)
    return out


def label_lines(lines: list[list[str]], field: Field, known: _Shapes) -> dict[int, np.ndarray]:
    """Labels of the lines that have any word that is not outside, by number of the line."""
    counts = np.fromiter(map(len, lines), np.int64, len(lines))
    numbers: list[int] = []
    for words in lines:  # A shape 0 before and after each line.
        numbers.append(0)
        numbers.extend([known[w] for w in words])
    numbers.append(0)
    shapes = np.array(numbers, np.int64)
    own, before, after = known.arrays()
    gain = [(t[:, 1:] - t[:, :1]).max(axis=1) for t in (own, before, after)]
    bound = gain[0][shapes[1:-1]] + gain[1][shapes[:-2]] + gain[2][shapes[2:]] + field.slack.max()
    bound[shapes[1:-1] == 0] = -np.inf
    doubt = np.flatnonzero(bound >= 0)
    by_label = own[shapes[doubt + 1]] + before[shapes[doubt]] + after[shapes[doubt + 2]]
    bound[doubt] = (by_label[:, 1:] - by_label[:, :1] + field.slack).max(axis=1)
    starts = np.cumsum(counts + 1) - counts - 1  # Of each line's first word within ``bound``.
    loud = np.unique(np.searchsorted(starts, np.flatnonzero(bound >= 0), side="right") - 1) if len(bound) else []
    out = {}
    order = sorted((int(i) for i in loud), key=lambda i: -counts[i])
    while order:
        longest = int(counts[order[0]])
        group = order[:max(1, _TOKENS // 4 // longest)]
        order = order[len(group):]
        emit = np.zeros((len(group), longest, len(LABELS)))
        for k, i in enumerate(group):
            at = shapes[starts[i]:starts[i] + counts[i] + 2]
            emit[k, :counts[i]] = own[at[1:-1]] + before[at[:-2]] + after[at[2:]]
        found = viterbi(emit, counts[group], field.steps)
        for k, i in enumerate(group):
            if found[k, :counts[i]].any():
                out[i] = found[k, :counts[i]]
    return out


_SPELLED = re.compile(r"[\w.%+-]+\s?(?:@|[(\[]at[)\]])\s?[A-Za-z0-9-]+(?:(?:\.|\s?[(\[]dot[)\]]\s?)[A-Za-z0-9-]+)+")


def _checked(kind: str, found: str) -> bool:
    """The arithmetic that any span of a kind must meet, however it is written."""
    numbers = re.findall(r"[0-9]+", found)
    digits = "".join(numbers)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 7 <= len(digits) <= 15 and not re.search(r"[^\W\d_]|[@=_/]", found)
    if kind == "ip":
        return len(numbers) == 4 and all(len(x) < 4 and int(x) < 256 for x in numbers)
    return bool(_SPELLED.fullmatch(found))


def _line_spans(line: str, labels: np.ndarray) -> Iterator[tuple[int, int, str]]:
    words = [(m.start(), m.end()) for m in re.finditer(r"\S+", line)]
    t = 0
    while t < len(labels):
        if LABELS[labels[t]].startswith("B-"):
            kind, first = LABELS[labels[t]][2:], t
            while t + 1 < len(labels) and LABELS[labels[t + 1]] == f"I-{kind}":
                t += 1
            start, end = words[first][0], words[t][1]
            lead = re.match(r"[\"'<{,;:!?.]*", line[start:end]).end()
            tail = len(re.search(r"[\"'>},;:!?.]*$", line[start:end])[0])
            start, end = start + lead, max(end - tail, start + lead)
            if _checked(kind, line[start:end]):
                yield start, end, kind
        t += 1


def find_spans(texts: Sequence[str], field: Field, known: _Shapes | None = None) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans and those that the field adds; added ones overlap no base span."""
    known = _Shapes(field) if known is None else known
    out = [(base_spans(t), []) for t in texts]
    for first, end in slices(np.fromiter(map(len, texts), np.int64, len(texts)), 5 * _TOKENS):
        if len(known) > _SHAPES:
            known.clear()
        lines, places = [], []
        for i in range(first, end):
            at = 0
            for line in texts[i].split("\n"):
                words = line.split()
                if words:
                    lines.append(words)
                    places.append((i, at, line))
                at += len(line) + 1
        for k, labels in label_lines(lines, field, known).items():
            i, at, line = places[k]
            for start, stop, kind in _line_spans(line, labels):
                start, stop = start + at, stop + at
                if all(stop <= s or e <= start for s, _, _, e in out[i][0]):
                    out[i][1].append((start, KINDS.index(kind), kind, stop))
    return out


_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """(doc_id, base, added) per row of ``docs``: spans as (start, rank, kind, end), in code points, end exclusive.

    Null text counts as empty and has no spans. Repeated rows get equal answers, an empty table gives no
    rows; other columns, whatever their names, are not read. Very long texts are read whole; a line is one
    chain, and one with a doubtful word takes nine numbers a word while it is decoded.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field or train())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Shapes(shared.value)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            found = find_spans(texts, shared.value, known)
            as_rows = [[[{"start": s, "rank": r, "kind": k, "end": e} for s, r, k, e in spans] for spans in pair]
                       for pair in found]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "base": [b for b, _ in as_rows],
                                "added": [a for _, a in as_rows]})

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {ids}, base {_SPANS}, added {_SPANS}")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, all spans as text, and the number added."""
    return found.select(
        "doc_id", *count_kinds("base", KINDS), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
