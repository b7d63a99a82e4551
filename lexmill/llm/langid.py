"""Language of each text and of each stretch of a mixed text.

A byte convolutional network (byte embedding, filters of several widths, max
pooling over the window, softmax) is trained in numpy on labelled texts and
applied to fixed-length windows of bytes, one per word, in batches. A text's
stretches are the most probable path through its words' scores, where a stretch
has at least ``MIN_RUN`` words: single borrowed, quoted or bracketed words and
names stay in the stretch around them. A stretch most of whose words are in
neither script is ``OTHER``.

Training reads a bounded sample of labelled rows (``sample_rows``), chosen by a
hash of the text, so the same rows at every run. Applying it is a map over
batches: no shuffle, and the model (about 40 kB) travels with the task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.plans.runtime import bounded_sample

#: Languages told apart.
LANGS = ("en", "hi", "hi-Latn", "mr")
#: Any other language.
OTHER = "und"
#: Rows of the training sample, all of them labelled.
SAMPLE_ROWS = 16_000
#: Bytes in a window, filter widths, filters of each width, embedding size.
WINDOW, WIDTHS, FILTERS, DIM = 24, (2, 3, 4, 5), 24, 12
#: Words in the shortest stretch.
MIN_RUN = 3
#: Log weight of going to another language where the script changes, after a mark or line end, and elsewhere.
SWITCH_SCRIPT, SWITCH_MARK, SWITCH_PLAIN = 3.0, 4.0, 5.5
#: Log weight of a word in a language that isn't written in its script.
WRONG_SCRIPT = -5.0

# --- fixed values: ways to write a language label -----------------------------
LANG_CODES = {"hi": "hi", "hin": "hi", "hindi": "hi", "en": "en", "eng": "en", "english": "en", "mr": "mr", "mar": "mr", "marathi": "mr", "mixed": "mixed", "mul": "mixed", "multi": "mixed", "multiple": "mixed", "multilingual": "mixed", "hinglish": "hi-Latn"}
LATIN_SCRIPT = ("latn", "latin", "roman", "romanized", "romanised")
NO_LABEL = ("", "-", "--", "?", "??", "???", "und", "unk", "unknown", "none", "null", "n/a", "na", "nan", "tbd", "zxx", "xx", "xxx", ".", "*", "_", "(none)", "undefined", "undetermined", "missing", "todo")
# ------------------------------------------------------------------------------

_STRIP = "^[\\s\\x{85}\\p{Z}]+|[\\s\\x{85}\\p{Z}]+$"
#: A word: no blank or dividing mark inside, with a letter; its outer marks are no part of it.
_TOKEN = re.compile(r"[^\s—–;,|/।…=()\[\]{}«»“”\"]+")
_EDGES = re.compile(r"^[^\wऀ-ॣ]+|[^\wऀ-ॣ]+$")
_OURS = re.compile(r"[A-Za-zÀ-ɏऀ-ॿ]")
_LETTER = re.compile(r"[^\W\d_]")
_MARK = re.compile(r"[^\w\sऀ-ॣ'’]|\n")


def canonical_label(c: Column) -> Column:
    """A label as one of LANGS or "mixed"; null if it says nothing; "other" if it names another language."""
    low = F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), _STRIP, ""))
    parts = F.split(low, "[-_\\s/().,]+")
    codes = F.create_map(*[F.lit(x) for kv in LANG_CODES.items() for x in kv])
    base = F.coalesce(codes[parts[0]], F.lit("other"))
    latin = F.arrays_overlap(parts, F.lit(list(LATIN_SCRIPT)))
    named = F.coalesce(codes[F.try_element_at(F.filter(parts, lambda p: p.isin(*LANG_CODES)), F.lit(1))], F.lit("other"))
    base = F.when(base == "other", F.when(parts[0].isin(*LATIN_SCRIPT), named).otherwise(base)).otherwise(base)
    return F.when(low.isin(*NO_LABEL), None).when((base == "hi") & latin, "hi-Latn").otherwise(base)


def words_of(text: str) -> list[str]:
    return [w for t in _TOKEN.findall(text) if _LETTER.search(t) and (w := _EDGES.sub("", t))]


def switches(text: str) -> list[float]:
    """Per word of the text: the weight of a switch of language before it."""
    out, end, script = [], 0, None
    for m in _TOKEN.finditer(text):
        if not _LETTER.search(m[0]):
            continue
        own = _devanagari(m[0])
        marked = _MARK.search(text, end, m.start()) or (end and text[end - 1] in ".!?:'’")
        out.append(SWITCH_SCRIPT if script is not None and own != script else SWITCH_MARK if marked else SWITCH_PLAIN)
        end, script = m.end(), own
    return out


def _devanagari(word: str) -> bool:
    return any("ऀ" <= c <= "ॿ" for c in word)


def script_mask(words: list[str]) -> np.ndarray:
    """[n, LANGS] log weights of each word's script under each language."""
    deva = np.array([_devanagari(w) for w in words], bool).reshape(-1, 1)
    written = np.array([lang in ("hi", "mr") for lang in LANGS])
    return np.where(deva == written, 0, WRONG_SCRIPT).astype(np.float32)


def windows(words: list[str]) -> np.ndarray:
    """[n, WINDOW] bytes: each word between blanks, cut or padded with 0. Longer words keep both ends."""
    out = np.zeros((len(words), WINDOW), np.uint8)
    for i, w in enumerate(words):
        b = b" " + w.lower().encode("utf-8", "replace") + b" "
        if len(b) > WINDOW:
            b = b[: WINDOW // 2] + b[-(WINDOW - WINDOW // 2) :]
        out[i, : len(b)] = np.frombuffer(b, np.uint8)
    return out


@dataclass
class ByteCNN:
    """Weights of the network; ``scores`` gives log probabilities."""

    embed: np.ndarray  # [256, DIM]
    filters: list[np.ndarray]  # per width [width * DIM, FILTERS]
    bias: list[np.ndarray]
    out: np.ndarray  # [len(WIDTHS) * FILTERS, classes]
    out_bias: np.ndarray

    @staticmethod
    def fresh(classes: int, seed: int = 7) -> ByteCNN:
        r = np.random.default_rng(seed)
        return ByteCNN(
            r.normal(0, 0.3, (256, DIM)).astype(np.float32),
            [r.normal(0, (2 / (w * DIM)) ** 0.5, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            r.normal(0, 0.1, (len(WIDTHS) * FILTERS, classes)).astype(np.float32),
            np.zeros(classes, np.float32),
        )

    def _forward(self, x: np.ndarray) -> tuple:
        e = self.embed[x]  # [n, WINDOW, DIM]
        n = len(x)
        pooled, arg, cols = [], [], []
        for w, f, b in zip(WIDTHS, self.filters, self.bias, strict=True):
            c = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2).reshape(n, WINDOW - w + 1, w * DIM)
            a = c @ f + b
            k = a.argmax(1)
            pooled.append(np.take_along_axis(a, k[:, None, :], 1)[:, 0])
            arg.append(k)
            cols.append(c)
        h = np.maximum(np.concatenate(pooled, 1), 0)
        return h, arg, cols, h @ self.out + self.out_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(x), 2048):
            z = self._forward(x[i : i + 2048])[3]
            z = z - z.max(1, keepdims=True)
            out.append(z - np.log(np.exp(z).sum(1, keepdims=True)))
        return np.concatenate(out) if out else np.zeros((0, len(self.out_bias)), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.out, self.out_bias]

    def gradients(self, x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted cross entropy against target probabilities."""
        n = len(x)
        h, arg, cols, z = self._forward(x)
        z = z - z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        dz = (p - target) * (weight / weight.sum())[:, None]
        d_out, d_out_bias = h.T @ dz, dz.sum(0)
        dh = (dz @ self.out.T) * (h > 0)
        d_embed = np.zeros_like(self.embed)
        d_e = np.zeros((n, WINDOW, DIM), np.float32)
        d_filters, d_bias = [], []
        for j, w in enumerate(WIDTHS):
            da = dh[:, j * FILTERS : (j + 1) * FILTERS]  # reaches the position that won the pooling
            picked = np.take_along_axis(cols[j], arg[j][:, :, None], 1)  # [n, FILTERS, w * DIM]
            d_filters.append(np.einsum("nfc,nf->cf", picked, da))
            d_bias.append(da.sum(0))
            dc = (da[:, :, None] * self.filters[j].T[None]).reshape(n, FILTERS, w, DIM)
            won = np.zeros((n, WINDOW - w + 1, FILTERS), np.float32)
            np.put_along_axis(won, arg[j][:, None, :], 1, 1)
            for k in range(w):
                d_e[:, k : k + WINDOW - w + 1] += won @ dc[:, :, k]
        flat = x.ravel()
        for d in range(DIM):
            d_embed[:, d] = np.bincount(flat, d_e[..., d].ravel(), 256)
        return [d_embed, *d_filters, *d_bias, d_out, d_out_bias]


def train(labelled: list[tuple[str, str]], epochs: int = 12, batch: int = 256, rate: float = 0.005, seed: int = 7) -> ByteCNN:
    """Fit the network to (text, label) pairs; a label is one of LANGS or "mixed". Some may be wrong.

    A word's target is the share of its languages over the sample, languages
    weighted equally; words of another script than their language's are left
    out. A first fit takes texts of one language by their labels; a second one
    takes all texts, each stretch by the language the first found for it. No
    pairs: a network that knows nothing.
    """
    model = ByteCNN.fresh(len(LANGS), seed)
    texts = [(words_of(t), LANGS.index(lang)) for t, lang in labelled if lang in LANGS]
    for last in (False, True):
        counts: dict[str, np.ndarray] = {}
        total = np.zeros(len(LANGS))
        for words, y in texts:
            own = LANGS[y] in ("hi", "mr")
            for w in words:
                if _devanagari(w) == own:
                    counts.setdefault(w.lower(), np.zeros(len(LANGS)))[y] += 1
                    total[y] += 1
        if not counts:
            return model
        scale = np.where(total > 0, 1 / np.maximum(total, 1), 0)
        vocabulary = sorted(counts)
        shares = np.array([counts[w] * scale for w in vocabulary])
        target = ((shares + 1e-7) / (shares + 1e-7).sum(1, keepdims=True)).astype(np.float32)
        weight = np.sqrt(shares.sum(1) / shares.sum(1).max()).astype(np.float32) + 0.02
        model = _fit(ByteCNN.fresh(len(LANGS), seed), windows(vocabulary), target, weight, epochs if last else epochs * 2 // 3, batch, rate, seed)
        if not last:
            words = [words_of(t) for t, _ in labelled]
            known = word_scores(model, sorted({w.lower() for ws in words for w in ws}))
            found = stretches([np.array([known[w.lower()] for w in ws], np.float32).reshape(-1, len(LANGS)) for ws in words], [switches(t) for t, _ in labelled])
            texts = [(ws[a : a + n], y) for ws, runs in zip(words, found, strict=True) for a, n, y, _ in runs]
    return model


def word_scores(model: ByteCNN, words: list[str]) -> dict[str, np.ndarray]:
    """Log weight of each (lower-case) word under each language."""
    return dict(zip(words, model.scores(windows(words)) + script_mask(words), strict=True)) if words else {}


def _fit(model: ByteCNN, x: np.ndarray, target: np.ndarray, weight: np.ndarray, epochs: int, batch: int, rate: float, seed: int) -> ByteCNN:
    """Adam over shuffled batches; more epochs, of as many steps, on small samples. The weights are the mean over the last third of the epochs."""
    r = np.random.default_rng(seed)
    params = model.parameters()
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    epochs = max(epochs, min(60, 25 * epochs * batch // max(len(x), 1)))
    t, late = 0, [np.zeros_like(p, np.float64) for p in params]
    taken = max(epochs // 3, 1)
    for epoch in range(epochs):
        order = r.permutation(len(x))
        step = rate * (1 - epoch / epochs) + rate * 0.05
        for i in range(0, len(x), batch):
            k = order[i : i + batch]
            t += 1
            for p, g, a, b in zip(params, model.gradients(x[k], target[k], weight[k]), m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= step * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
        if epoch >= epochs - taken:
            for p, mean in zip(params, late, strict=True):
                mean += p / taken
    for p, mean in zip(params, late, strict=True):
        p[...] = mean
    return model


def single(words: list[str], known: dict[str, np.ndarray]) -> tuple[int, int, int, float] | None:
    """The one stretch of a text whose best path surely has no switch; None: look closer.

    Over the language of the greatest total, a path gains at most the sum of
    what each word's best language gains; and in each stretch at most the best
    sum of score differences of any run of words in one language. Of m stretches
    m - 1 pay for a switch, so no path with one is better if the first is within
    the least weight of a switch or the second within half of it.
    """
    s = np.array([known[w] for w in words], np.float64)
    total = s.sum(0)
    y = int(total.argmax())
    gain = s - s[:, y : y + 1]
    # (paths are summed in single precision)
    least = min(SWITCH_SCRIPT, SWITCH_MARK, SWITCH_PLAIN) - 1e-3
    mean = total / len(words)
    one = 0, len(words), y, float(1 / np.exp(mean - mean[y]).sum())
    if float(gain.max(1).sum()) <= least:
        return one
    gain = gain.cumsum(0)
    low = np.minimum.accumulate(np.concatenate([np.zeros((1, len(LANGS))), gain[:-1]]), 0)
    return one if float((gain - low).max()) <= least / 2 else None


def stretches(scores: list[np.ndarray], costs: list[list[float]], min_run: int = MIN_RUN) -> list[list[tuple[int, int, int, float]]]:
    """Per text the (first word, words, language, confidence) of its stretches.

    All texts go together: a state is a language and how many words of its
    stretch were read (up to min_run), the path ends in a full stretch, or in any
    if the text has fewer words than two stretches.
    """
    n = len(scores)
    if not n:
        return []
    lengths = np.array([len(s) for s in scores])
    k, steps = len(LANGS), int(lengths.max(initial=0))
    order = np.argsort(-lengths, kind="stable")
    padded = np.zeros((n, steps, k), np.float32)
    cost = np.zeros((n, steps), np.float32)
    for row, i in enumerate(order):
        padded[row, : lengths[i]] = scores[i]
        cost[row, : lengths[i]] = costs[i]
    live = (lengths[order][None, :] > np.arange(steps)[:, None]).sum(1)  # texts that have a word t
    best = np.full((n, k, min_run), -1e9, np.float32)  # [text, language, words read - 1]
    back = np.zeros((steps, n, k, min_run), np.int16)  # previous language where a stretch begins; -1: none; -2: stayed in the last state
    if steps:
        best[: live[0], :, 0] = padded[: live[0], 0]
    for t in range(1, steps):
        a = live[t]
        old, new = best[:a], np.full((a, k, min_run), -1e9, np.float32)
        new[:, :, 1:] = old[:, :, :-1]
        stay = old[:, :, -1]
        longer = stay > new[:, :, -1]
        new[:, :, -1] = np.maximum(new[:, :, -1], stay)
        back[t, :a, :, -1] = np.where(longer, -2, -1)
        back[t, :a, :, 1:-1] = -1
        full = old[:, :, -1]
        top = np.argsort(-full, 1)[:, :2]
        for y in range(k):  # from the best other language
            src = np.where(top[:, 0] == y, top[:, 1], top[:, 0])
            new[:, y, 0] = full[np.arange(a), src] - cost[:a, t]
            back[t, :a, y, 0] = src
        best[:a] = new + padded[:a, t][:, :, None]
    out: list[list[tuple[int, int, int, float]]] = [[] for _ in range(n)]
    for row, i in enumerate(order):
        length = int(lengths[i])
        if not length:
            continue
        b = best[row] if length < min_run else best[row][:, -1:]
        y, r = divmod(int(b.argmax()), b.shape[1])
        r = r if length < min_run else min_run - 1
        ends, t = length, length - 1
        runs = []
        while t > 0:
            code = back[t, row, y, r]
            if r == 0:
                runs.append((t, ends - t, y))
                ends, y, r = t, int(code), min_run - 1
            elif not (r == min_run - 1 and code == -2):
                r -= 1
            t -= 1
        runs.append((0, ends, y))
        s = scores[i]
        for first, many, y in reversed(runs):
            mean = s[first : first + many].mean(0)
            p = np.exp(mean - mean.max())
            out[i].append((first, many, y, float(p[y] / p.sum())))
    return out


def training_sample(df: DataFrame, text: str, label: str, sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """At most ``sample_rows`` labelled texts, by hash order."""
    labelled = df.select(F.col(text).alias("t"), canonical_label(F.col(label)).alias("y")).where(F.col("y").isin(*LANGS, "mixed") & F.col("t").isNotNull())
    rows = bounded_sample(labelled, ["t", "y"], sample_rows)
    return [(r.t, r.y) for r in rows.collect()]


def label_languages(df: DataFrame, id_col: str, text: str, model: ByteCNN) -> DataFrame:
    """(id, seg, lang, confidence, first_word, n_words) per text and stretch.

    seg 0 is the whole text: its language, or "mixed" if it has stretches in two
    or more; its confidence is the weakest stretch's. seg 1, 2, ... are the
    stretches of a mixed text in order. A text or stretch most of whose words hold
    no letter of either script is ``OTHER``. A null or blank text, or one without a letter, has only
    seg 0 with lang null and confidence 0. Repeated ids stay.
    """
    src = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = dict(src.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        for b in batches:
            raw = [t or "" for t in b.column(1).to_pylist()]
            texts = [[w.lower() for w in words_of(t)] for t in raw]
            if len(known) > 300_000:
                known.clear()
            known.update(word_scores(model, sorted({w for ws in texts for w in ws} - known.keys())))
            found: list = [None] * len(texts)
            mixed = []
            for i, ws in enumerate(texts):
                if not ws:
                    found[i] = []
                elif (one := single(ws, known)) is not None:
                    found[i] = [one]
                else:
                    mixed.append(i)
            # texts of like length go together, so that a long one pads only its like
            mixed.sort(key=lambda i: len(texts[i]))
            at = 0
            while at < len(mixed):
                hi = at + 1
                while hi < len(mixed) and (hi + 1 - at) * len(texts[mixed[hi]]) <= 40_000:
                    hi += 1
                part = mixed[at:hi]
                for i, f in zip(part, stretches([np.array([known[w] for w in texts[i]], np.float32) for i in part], [switches(raw[i]) for i in part]), strict=True):
                    found[i] = f
                at = hi
            rows, seg, lang, conf, first, many = [], [], [], [], [], []
            for i, runs in enumerate(found):
                named = [(a, n, OTHER if 2 * sum(1 for w in texts[i][a : a + n] if not _OURS.search(w)) > n else LANGS[y], c) for a, n, y, c in runs]
                whole = None if not named else named[0][2] if len(named) == 1 else "mixed"
                for s, (a, n, y, c) in enumerate([(0, sum(r[1] for r in runs), whole, min((r[3] for r in runs), default=0.0)), *(named if len(named) > 1 else [])]):
                    rows.append(i), seg.append(s), lang.append(y), conf.append(c), first.append(a), many.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(seg, pa.int64()), pa.array(lang, pa.string()), pa.array(conf, pa.float64()), pa.array(first, pa.int64()), pa.array(many, pa.int64())], names=["id", "seg", "lang", "confidence", "first_word", "n_words"])

    return src.mapInArrow(run, f"id {id_type}, seg long, lang string, confidence double, first_word long, n_words long").withColumnRenamed("id", id_col)

