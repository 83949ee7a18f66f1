"""Secret scan: known formats, and strings whose characters are close to random.

Three kinds are found by their format (`assign`, `access`, `hex`). The others come from the
method: candidate strings in which a window of `window` characters reaches a Shannon entropy
that no ordinary word of their character class has. Candidates are runs of base64 characters,
the runs of letters and digits in them (so that a name before `=` or a path around a key does
not hide it), and hexadecimal groups joined by dashes, whose dashes do not count. The window
slides one character at a time and keeps a count for each character; what enters and what
leaves changes one term of the sum each. A candidate on the allow list is suppressed.

Everything is SQL built-ins on one row: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import add_columns


def _any_case(words: list[str]) -> str:
    return "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in words)


#: Fixed by the contract: what is found by format, and the length a find must have.
ASSIGN = f"""({_any_case(["password", "passwd", "secret", "token", "api_?key"])})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

#: Candidates of the entropy kinds, and the character classes: alphabet and bits per character
#: that a window has to reach. 20 characters have at most 4.32 bits; ordinary words of that
#: length stay below 3.5, random base64 has 4.1, random hexadecimal digits 3.3.
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CLASSES = {
    "entropy_hex": ("^[0-9a-fA-F]*([0-9][a-fA-F]|[a-fA-F][0-9])[0-9a-fA-F]*$", 2.95),
    "entropy_base64": ("[A-Z].*[0-9]|[0-9].*[A-Z]", 3.85),
    "entropy_lower": ("^(?=(?:.*?[0-9][a-z]){3})[a-z0-9]+$", 3.5),
    "entropy_upper": ("^[A-Z]+$", 3.9),
    "entropy_letters": ("^(?=(?:.*?[a-z][A-Z]){5})[A-Za-z]+$", 3.9),
    "entropy_dashed": ("^(?=.*[0-9])(?=.*[a-fA-F])", 2.95),
}
#: Strings of the classes: base64 is looked for in CANDIDATE, dashed groups in DASHED, the others in RUN.
RUN = "[A-Za-z0-9]{20,}"
DASHED = "(?<![A-Za-z0-9+/_=-])[0-9a-fA-F]{2,}(?:-[0-9a-fA-F]{2,})+(?![A-Za-z0-9+/_=-])"
#: A string is of the first of these classes that it fits.
RUN_CLASSES = ["entropy_hex", "entropy_lower", "entropy_upper", "entropy_letters"]
#: Suppressed: a few characters repeated, runs of the alphabet or of digits, paths, words and
#: numbers joined by dashes or underscores, keys that documentation uses.
ALLOWED = [
    "^(.{1,4})\\1{3,}.{0,3}$",
    "(?i)0123456789abcdef|abcdefghijklmnop",
    "^([A-Za-z]+|[0-9]+)([/_=-]([A-Za-z]*|[0-9]+))+$",
    "EXAMPLE",
]
BLOCK = 512
ORDER = ["assign", "access", "hex", *CLASSES]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(numbers: Column) -> Column:
    none = F.expr("cast(array() as array<int>)")
    return F.aggregate(
        numbers, none, lambda sums, n: F.concat(sums, F.array(F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0)) + n))
    )


def _prefix_sums(numbers: Column) -> Column:
    """Running sums of a non-empty array, in blocks: appending copies a block, not the array."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int")),
        lambda b: _running(F.slice(numbers, b * BLOCK + 1, F.lit(BLOCK))),
    )

    def joined(blocks: Column) -> Column:
        ends = _running(F.transform(blocks, lambda b: F.get(b, F.size(b) - 1)))
        before = F.concat(F.array(F.lit(0)), F.slice(ends, F.lit(1), F.size(blocks) - 1))
        return F.flatten(F.zip_with(blocks, before, lambda block, base: F.transform(block, lambda n: n + base)))

    return _let(blocks, joined)


def _finds(text: Column, pattern: str) -> Column:
    """Array of (match, start) of the leftmost non-overlapping matches; empty if there is none.

    What lies between the matches and the matches themselves give the places by their lengths.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(found: Column) -> Column:
        lengths = F.zip_with(
            F.transform(F.slice(gaps, F.lit(1), F.size(found)), F.char_length),
            found,
            lambda gap, match: gap + F.char_length(match),
        )
        return F.zip_with(
            found,
            _prefix_sums(lengths),
            lambda match, end: F.struct(match.alias("match"), (end - F.char_length(match)).alias("start")),
        )

    none = F.expr("cast(array() as array<struct<match: string, start: int>>)")
    return F.when(F.regexp_like(text, F.lit(pattern)), _let(matches, placed)).otherwise(none)


def _spans(finds: Column, kind: str) -> Column:
    return F.transform(
        finds,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(ORDER.index(kind)).alias("rank"),
            (x["start"] + F.char_length(x["match"])).alias("end"),
        ),
    )


def _xlog(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def peak_entropy(string: Column, window: int = WINDOW) -> Column:
    """Largest entropy in bits of any window of `string`, which has at least `window` characters.

    With c(x) the count of a character, the entropy is log2(w) - sum(c log2 c) / w; entering and
    leaving characters change one term each.
    """
    letters = F.slice(F.split(string, ""), F.lit(1), F.char_length(string))
    codes = F.transform(letters, lambda letter: F.position(letter, F.lit(ALPHABET)))

    def slide(codes: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"),
            F.lit(0.0).alias("sum"),
            F.lit(1e9).alias("least"),
        )

        def move(state: Column, place: Column) -> Column:
            enters = F.get(codes, place)
            leaves = F.when(place >= window, F.get(codes, place - window)).otherwise(F.lit(-1))

            def counted(counts: Column) -> Column:
                came, gone = F.get(counts, enters), F.get(counts, F.greatest(leaves, F.lit(0)))
                moved = F.when(enters == leaves, F.lit(0.0)).otherwise(
                    _xlog(came + 1)
                    - _xlog(came)
                    + F.when(leaves < 0, F.lit(0.0)).otherwise(_xlog(gone - 1) - _xlog(gone))
                )
                after = F.transform(
                    counts,
                    lambda c, i: c + (i == enters).cast("int") - (i == leaves).cast("int"),
                )
                total = state["sum"] + moved
                least = F.when(place >= window - 1, F.least(state["least"], total)).otherwise(state["least"])
                return F.struct(after.alias("counts"), total.alias("sum"), least.alias("least"))

            return _let(state["counts"], counted)

        return F.aggregate(
            F.sequence(F.lit(0), F.size(codes) - 1),
            start,
            move,
            lambda state: F.log2(F.lit(float(window))) - state["least"] / window,
        )

    return _let(codes, slide)


def scan_secrets(docs: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """`docs` with `secrets`, an array of (start, kind, end, value) in order of start and kind.

    Places count code points, `end` is exclusive. Kinds: `assign`, `access`, `hex`, and the
    entropy kinds, those of CLASSES, which leave out candidates that match a pattern of
    `allowed` (default `ALLOWED`). NULL text is empty and has none. Equal rows give
    equal results; an input column `secrets` is replaced, all others stay.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    allow = ALLOWED if allowed is None else allowed
    assign = F.filter(
        _finds(text, ASSIGN), lambda x: F.char_length(F.regexp_extract(x["match"], ASSIGN, 2)) >= ASSIGN_CHARS
    )
    kinds = [_spans(assign, "assign"), _spans(_finds(text, ACCESS), "access"), _spans(_finds(text, HEX), "hex")]

    def of_class(kind: str, finds: Column, string: Callable[[Column], Column] = lambda x: x) -> Column:
        pattern, bits = CLASSES[kind]
        before = RUN_CLASSES[: RUN_CLASSES.index(kind)] if kind in RUN_CLASSES else []

        def random(x: Column) -> Column:
            own = string(x["match"])
            mine = (F.char_length(own) >= WINDOW) & F.regexp_like(own, F.lit(pattern))
            for p in (*(CLASSES[k][0] for k in before), *allow):
                mine = mine & ~F.regexp_like(x["match"], F.lit(p))
            return F.when(mine, peak_entropy(own) >= bits).otherwise(F.lit(False))

        return _spans(F.filter(finds, random), kind)

    runs = _finds(text, RUN)
    kinds += [of_class(kind, runs) for kind in RUN_CLASSES]
    kinds.append(of_class("entropy_base64", _finds(text, CANDIDATE)))
    kinds.append(of_class("entropy_dashed", _finds(text, DASHED), lambda match: F.replace(match, F.lit("-"))))
    names = F.array(*(F.lit(k) for k in ORDER))
    named = F.transform(
        F.array_sort(F.concat(*kinds)),
        lambda s: F.struct(
            s["start"].alias("start"),
            F.get(names, s["rank"]).alias("kind"),
            s["end"].alias("end"),
            F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("value"),
        ),
    )
    return add_columns(docs, secrets=named)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and span lists of a scan, one row for each document."""
    base = ["assign", "access", "hex"]
    spans = F.col("secrets")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(array: Column) -> Column:
        return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    own = F.filter(spans, lambda s: s["kind"].isin(base))
    return scanned.select(
        "doc_id",
        *(count(k) for k in base),
        F.sha2(listed(own), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )
