"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides.

Everything is DataFrame functions: spans come from the pieces between the matches of a pattern, votes and features are
expressions over a span and what stands before it. Texts are read once; the candidates are stored, then counted by
vote pattern and by feature pattern. These patterns are few whatever the input (products of a few values each), so
expectation-maximisation and the logistic fit run over their counts in the driver, in plain Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.store import stored

#: Kinds in the order in which spans with the same start stand.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("number", "secret", "name")

# The base patterns, with guards that keep a failing search linear: a run is entered only at its start or where the
# match before it ended. A card's pattern takes only runs of 12 to 19 digits, as the others would be dropped.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

_NUMBER = r"(?<![0-9A-Za-z.@-])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+(?![0-9A-Za-z@])"
_SECRET = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{16,}+"
_NAME = r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Señor|Señora)\.? \p{Lu}[\p{L}'-]*+(?: \p{Lu}[\p{L}'-]++){0,2}"

#: Gazetteers of the labelers: how secrets begin, and words before a span that speak for or against personal data.
_PREFIXES = r"^(?:AKIA|ASIA|gh[pousr]_|sk-|pk_|xox[abp]-|AIza|eyJ)"
_CUES = (
    r"(?i)(?:tel|phone|mobile|fax|call|contact|card|visa|account|konto|iban|ssn|passport|key|token|secret|password|passwd"
    r"|credential|auth|api|téléphone|teléfono|telefon|carte|tarjeta|karte|mr|mrs|dr|herr|frau)\W{0,6}\w{0,6}\W{0,4}$"
)
_AGAINST = r"(?i)(?:page|version|chapter|figure|isbn|order|year|vol|no|nr|seite|página|§)\W{0,3}$"

#: Titles that nothing but a name follows, and offices and other words that follow titles and are no names.
_TITLES = r"^(?:Mrs?|Herr|Frau|Mme|Señora?)\b"
_OFFICES = (
    r"^\p{L}+\.? (?:Speaker|President|Chairman|Chairwoman|Chair|Minister|Ministerin|Secretary|Ambassador|Professor|Doctor|Doktor"
    r"|Justice|Right|Wrong|Nobody|Präsident|Präsidentin|Kanzler|Kanzlerin|Président|Présidente|Ministre|Presidente|Presidenta"
    r"|Ministra|Ministro)\b"
)

#: Items that are folded at a time.
RUN = 256

#: Characters before a span that the context labeler sees.
CONTEXT = 24

LABELERS = ("regex", "gazetteer", "context", "checksum", "length")
FEATURES = ("kind", "digits", "length", "cue", "known", "checksum", "mixed")

EM_ROUNDS = 30
FIT_ROUNDS = 400
LEAST_PROBABILITY = 0.5


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used in lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def scanned(
    items: Column, zero: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], kind: str
) -> Column:
    """``emit(state, item)`` of every item in order, of type ``kind``, where ``step(state, item)`` is the next state.

    What a fold appends to is copied, so items are folded in runs of ``RUN`` and the runs' results are flattened: the
    time is in proportion to the items. ``items`` should be a plain column or a lambda's variable.
    """
    none = F.array().cast(f"array<{kind}>")

    def run(before: Column, own: Column) -> Column:
        return F.aggregate(
            own,
            F.struct(before.alias("state"), none.alias("done")),
            lambda acc, x: F.struct(
                step(acc["state"], x).alias("state"), F.concat(acc["done"], F.array(emit(acc["state"], x))).alias("done")
            ),
        )

    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / RUN).cast("int")), lambda i: F.slice(items, i * RUN + 1, F.lit(RUN))
    )
    start = F.array(F.struct(zero.alias("state"), none.alias("done")))
    folded = F.aggregate(runs, start, lambda acc, own: F.concat(acc, F.array(run(F.element_at(acc, -1)["state"], own))))
    return F.when(F.size(items) > 0, F.flatten(F.transform(folded, lambda r: r["done"]))).otherwise(none)


_SPAN = "struct<start:int,end:int,value:string,before:string>"


def spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, value, before) of the matches of ``pattern``, leftmost and non-overlapping, in code points.

    ``before`` are the last ``CONTEXT`` characters in front of the match.
    """

    def place(zipped: Column) -> Column:
        after = lambda at, x: at["at"] + F.length(x["gap"])
        return scanned(
            zipped,
            F.struct(F.lit(0).alias("at"), F.lit("").alias("tail")),
            lambda at, x: F.struct(
                (after(at, x) + F.length(x["value"])).alias("at"), _last(F.concat(at["tail"], x["gap"], x["value"])).alias("tail")
            ),
            lambda at, x: F.struct(
                after(at, x).alias("start"),
                (after(at, x) + F.length(x["value"])).alias("end"),
                x["value"].alias("value"),
                _last(F.concat(at["tail"], x["gap"])).alias("before"),
            ),
            _SPAN,
        )

    def found(values: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(values))
        some = let(F.arrays_zip(gaps.alias("gap"), values.alias("value")), place)
        return F.when(F.size(values) > 0, some).otherwise(F.array().cast(f"array<{_SPAN}>"))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found)


def _last(text: Column) -> Column:
    return F.right(text, F.lit(CONTEXT))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass: every second one from the right counts twice, less 9 if that is above 9."""
    reverse = F.split(F.reverse(digits(value)), "")

    def term(x: Column, i: Column) -> Column:
        twice = F.try_to_number(x, F.lit("9")).cast("int") * (1 + i % 2)
        return F.coalesce(F.when(twice > 9, twice - 9).otherwise(twice), F.lit(0))

    return F.aggregate(F.transform(reverse, term), F.lit(0), lambda a, x: a + x) % 10 == 0


def _base(text: Column) -> dict[str, Column]:
    """The base spans of each kind: matches that fail their check are dropped."""
    parts = lambda x: F.transform(F.split(x["value"], r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    small = lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255"))
    n_digits = lambda x: F.length(digits(x["value"]))
    none = F.array().cast(f"array<{_SPAN}>")
    return {
        "email": F.when(F.contains(text, F.lit("@")), spans(text, _EMAIL)).otherwise(none),
        "ip": F.filter(spans(text, _IP), lambda x: F.forall(parts(x), small)),
        "card": F.filter(spans(text, _CARD), lambda x: luhn(x["value"])),
        "phone": F.when(
            F.contains(text, F.lit("+")), F.filter(spans(text, _PHONE), lambda x: n_digits(x).between(9, 15))
        ).otherwise(none),
    }


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _judged(candidate: Column) -> Column:
    """A candidate span with its votes and features; ``overlaps`` says whether a base span does."""
    value, before, kind, overlaps = (candidate[name] for name in ("value", "before", "kind", "overlaps"))
    n, size = F.length(digits(value)), F.length(value)
    number, secret, name = kind == 0, kind == 1, kind == 2
    cue, against = before.rlike(_CUES), before.rlike(_AGAINST)
    # a name has small letters, and more than two of all in its first word
    office, spelt, short = value.rlike(_OFFICES), value.rlike(r" \p{Lu}['-]?\p{Ll}"), ~value.rlike(r"^\p{L}+\.? [\p{L}'-]{3}")
    shaped = name & spelt & ~short & ~office
    known = value.rlike(_PREFIXES) | name & ~office & value.rlike(_TITLES) | shaped & value.rlike(r"^\p{L}+\.? \S+ ")
    grouped = value.rlike(r"^\+?[0-9]{1,3} \(?[0-9]{2,4}\)? ?[0-9]{3}|^(?:[0-9]{4}[ -]){3}[0-9]{4}|^\+[0-9]")
    mixed = value.rlike("[a-z]") & value.rlike("[A-Z]") | value.rlike("^[0-9A-Fa-f]{32,}$") | value.rlike("^[0-9A-Z]{20}$")
    # the base patterns drop a run of several numbers, of which one may pass
    part = F.exists(F.split(value, "[ -]"), lambda p: F.length(digits(p)).between(12, 19) & luhn(p))
    sound = number & (n.between(12, 19) & luhn(value) | (n > 19) & part)
    votes = {
        "regex": _vote(overlaps | number & grouped | secret & mixed | shaped, number & (n < 9) & ~grouped | name & ~shaped),
        "gazetteer": _vote(known, against | name & office),
        "context": _vote(cue, against),
        "checksum": _vote(sound | overlaps | secret & mixed, number & n.between(12, 19)),
        "length": _vote(number & n.between(9, 19) | secret & (size >= 20) | name & ~short, number & (n < 9) | name & short),
    }
    features = {
        "kind": kind,
        "digits": F.when(n < 9, 0).when(n < 12, 1).when(n < 20, 2).otherwise(3),
        "length": F.when(size < 16, 0).when(size < 32, 1).otherwise(2),
        "cue": F.when(cue, 2).when(against, 0).otherwise(1),
        "known": known.cast("int"),
        "checksum": sound.cast("int"),
        "mixed": (secret & mixed | number & grouped | shaped).cast("int"),
    }
    return F.struct(
        kind.alias("kind"),
        candidate["start"].alias("start"),
        candidate["end"].alias("end"),
        overlaps.alias("overlaps"),
        F.struct(*(votes[k].cast("int").alias(k) for k in LABELERS)).alias("votes"),
        F.struct(*(features[k].cast("int").alias(k) for k in FEATURES)).alias("features"),
    )


_EVENT = "struct<start:int,candidate:int,kind:int,end:int,value:string,before:string,overlaps:boolean>"


def _events(spans: Column, kind: int, candidate: bool) -> Column:
    return F.transform(
        spans,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(int(candidate)).alias("candidate"),
            F.lit(kind).alias("kind"),
            x["end"].alias("end"),
            x["value"].alias("value"),
            x["before"].alias("before"),
            F.lit(False).alias("overlaps"),
        ),
    )


def _marked(events: Column) -> Column:
    """Events in order of their start, base spans first, with ``overlaps`` where a base span has a character of a
    candidate: one that began before and reaches into it, or the next one that begins. One pass in each direction."""

    def told(x: Column, overlaps: Column) -> Column:
        kept = [x[name].alias(name) for name in ("start", "candidate", "kind", "end", "value", "before")]
        return F.struct(*kept, (x["overlaps"] | overlaps).alias("overlaps"))

    is_base = lambda x: x["candidate"] == 0
    forward = lambda x: scanned(
        x,
        F.lit(0),
        lambda reach, x: F.when(is_base(x), F.greatest(reach, x["end"])).otherwise(reach),
        lambda reach, x: told(x, reach > x["start"]),
        _EVENT,
    )
    backward = lambda x: scanned(
        x,
        F.lit((1 << 31) - 1),
        lambda begin, x: F.when(is_base(x), x["start"]).otherwise(begin),
        lambda begin, x: told(x, begin < x["end"]),
        _EVENT,
    )
    return let(F.reverse(let(F.array_sort(events), forward)), backward)


def candidates(docs: DataFrame, carried: Column) -> DataFrame:
    """(doc_id, carried, base, added) of each row: base spans (kind, start, end), and judged candidates for more."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", carried.alias("carried"), text.alias("text"))
    base = _base(F.col("text"))
    more = [spans(F.col("text"), p).alias(k) for k, p in zip(ADDED_KINDS, (_NUMBER, _SECRET, _NAME), strict=True)]
    rows = rows.select("doc_id", "carried", *(base[k].alias(k) for k in BASE_KINDS), *more)

    def tag(kind: int):
        return lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"))

    tagged = [F.transform(k, tag(i)) for i, k in enumerate(BASE_KINDS)]
    asked = [_events(F.col(k), i, True) for i, k in enumerate(ADDED_KINDS)]
    fixed = [_events(F.col(k), i, False) for i, k in enumerate(BASE_KINDS)]
    some = sum((F.size(k) for k in ADDED_KINDS), F.lit(0)) > 0
    marked = F.when(some, _marked(F.concat(*asked, *fixed))).otherwise(F.array().cast(f"array<{_EVENT}>"))
    rows = rows.select("doc_id", "carried", F.array_sort(F.concat(*tagged)).alias("base"), marked.alias("marked"))
    added = F.transform(F.filter("marked", lambda x: x["candidate"] == 1), _judged)
    return rows.select("doc_id", "carried", "base", added.alias("added"))


def reliabilities(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[dict[tuple[int, int], float]]]:
    """EM over vote patterns and their counts: the share of true spans, and P(vote | truth) of each labeler.

    The labelers are taken to be independent given the truth; it starts from their sum. Counts are smoothed by one.
    """
    posterior = [1 / (1 + exp(-float(sum(votes)))) for votes, _ in patterns]
    prior, tables = 0.5, []
    for _ in range(EM_ROUNDS):
        weight = {1: sum(p * n for p, (_, n) in zip(posterior, patterns, strict=True))}
        weight[0] = sum(n for _, n in patterns) - weight[1]
        prior = (weight[1] + 1) / (weight[0] + weight[1] + 2)
        tables = []
        for i in range(len(LABELERS)):
            counts = {(vote, truth): 1.0 for vote in (-1, 0, 1) for truth in (0, 1)}
            for p, (votes, n) in zip(posterior, patterns, strict=True):
                counts[votes[i], 1] += p * n
                counts[votes[i], 0] += (1 - p) * n
            tables.append({key: c / (weight[key[1]] + 3) for key, c in counts.items()})
        posterior = [_posterior(votes, prior, tables) for votes, _ in patterns]
    return prior, tables


def _posterior(votes: tuple[int, ...], prior: float, tables: list[dict[tuple[int, int], float]]) -> float:
    odds = log(prior / (1 - prior)) + sum(log(t[v, 1] / t[v, 0]) for v, t in zip(votes, tables, strict=True))
    return 1 / (1 + exp(-max(-30.0, min(30.0, odds))))


@dataclass(frozen=True)
class SpanClassifier:
    """Logistic weights of feature values; without any candidate it accepts nothing."""

    bias: float
    weights: dict[tuple[str, int], float]

    def accepts(self, candidate: Column) -> Column:
        total = F.lit(self.bias)
        for name in FEATURES:
            of = {value: w for (feature, value), w in self.weights.items() if feature == name}
            term = F.lit(0.0)
            for value, w in of.items():
                term = F.when(candidate["features"][name] == value, F.lit(w)).otherwise(term)
            total = total + term
        return total >= log(LEAST_PROBABILITY / (1 - LEAST_PROBABILITY))


def fit(found: DataFrame) -> SpanClassifier:
    """Trains the classifier on all candidates of ``found``, with the labelers' posterior as their label."""
    each = found.select(F.explode("added").alias("c")).select("c.votes", "c.features")
    grouped = each.groupBy("votes", "features").agg(F.count("*").alias("n")).collect()
    by_votes: dict[tuple[int, ...], int] = {}
    for row in grouped:
        by_votes[tuple(row["votes"])] = by_votes.get(tuple(row["votes"]), 0) + row["n"]
    if not by_votes:
        return SpanClassifier(-1.0, {})
    prior, tables = reliabilities(sorted(by_votes.items()))
    rows = [
        ([(k, row["features"][k]) for k in FEATURES], _posterior(tuple(row["votes"]), prior, tables), row["n"])
        for row in sorted(grouped, key=lambda r: (tuple(r["votes"]), tuple(r["features"])))
    ]
    total = sum(n for _, _, n in rows)
    weights = {name: 0.0 for names, _, _ in rows for name in names}
    squares = {name: 1e-8 for name in weights}
    bias, bias_square = 0.0, 1e-8
    for _ in range(FIT_ROUNDS):
        gradient, bias_gradient = {name: -0.001 * w for name, w in weights.items()}, 0.0
        for names, label, n in rows:
            score = bias + sum(weights[name] for name in names)
            error = (label - 1 / (1 + exp(-max(-30.0, min(30.0, score))))) * n / total
            bias_gradient += error
            for name in names:
                gradient[name] += error
        for name, g in gradient.items():
            squares[name] += g * g
            weights[name] += 0.3 * g / squares[name] ** 0.5
        bias_square += bias_gradient**2
        bias += 0.3 * bias_gradient / bias_square**0.5
    return SpanClassifier(bias, weights)


def personal_data(docs: DataFrame, carried: Column | None = None) -> DataFrame:
    """(doc_id, base, spans) for every row of ``docs`` (doc_id, text): arrays of (start, kind, end) in their order.

    ``carried``, a column over ``docs``, comes along under that name.

    ``base`` has the spans of the fixed patterns; ``spans`` also those candidates that the classifier accepts and that
    overlap no base span. Kinds are places in BASE_KINDS + ADDED_KINDS, starts and ends count code points. A null text is
    empty and has no spans; repeated rows and null ids stay, other columns are dropped.
    """
    found = stored(candidates(docs, F.lit(True) if carried is None else carried))
    model = fit(found)
    added = F.filter("added", lambda c: ~c["overlaps"] & model.accepts(c))
    shifted = F.transform(
        added, lambda c: F.struct(c["start"].alias("start"), (c["kind"] + len(BASE_KINDS)).alias("kind"), c["end"].alias("end"))
    )
    along = [] if carried is None else ["carried"]
    return found.select("doc_id", *along, "base", F.array_sort(F.concat("base", shifted)).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in BASE_KINDS + ADDED_KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == BASE_KINDS.index(kind))).cast("long")


#: Characters in the pieces that a text is cut into before it is put together again.
_PIECE = 1024


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from start to end of a text in pieces; only the pieces that hold some of them are looked at."""
    first, last = F.floor(start / _PIECE).cast("int"), F.floor((end - 1) / _PIECE).cast("int")

    def own(piece: Column, i: Column) -> Column:
        begin = F.when(i == 0, start % _PIECE).otherwise(0)
        stop = F.when(i == last - first, (end - 1) % _PIECE + 1).otherwise(_PIECE)
        return F.substring(piece, begin + 1, stop - begin)

    some = F.array_join(F.transform(F.slice(pieces, first + 1, last - first + 1), own), "")
    return F.when(end > start, some).otherwise("")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span written as its kind in brackets; overlapping spans are one, of the first one's kind."""
    kinds = F.array(*(F.lit(f"[{k.upper()}]") for k in BASE_KINDS + ADDED_KINDS))

    def put(v: Column) -> Column:
        parts = scanned(
            v["spans"],
            F.lit(0),
            lambda at, s: F.greatest(at, s["end"]),
            lambda at, s: F.when(
                s["start"] >= at, F.concat(_between(v["pieces"], at, s["start"]), F.element_at(kinds, s["kind"] + 1))
            ).otherwise(""),
            "string",
        )
        reach = F.aggregate(v["spans"], F.lit(0), lambda at, s: F.greatest(at, s["end"]))
        return F.concat(F.array_join(parts, ""), _between(v["pieces"], reach, v["length"]))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
    cut = F.struct(pieces.alias("pieces"), spans.alias("spans"), F.length(text).alias("length"))
    return F.when(F.size(spans) > 0, let(cut, put)).otherwise(text)
