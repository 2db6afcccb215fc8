"""Operator 9: personal data by weak supervision.

Base spans come from four patterns (email, ip, card, phone) with their checks and
are always kept.  Beyond them, each sort of labeler proposes spans: formats (account
numbers in groups, telephone numbers without a plus, keys without a digit), word
lists (a title or a first name before capitalised words, a street with its number),
contexts (what follows ``password:`` and the like), and any word with a digit, ``@``
or ``=``.  Candidates are the proposals that no base span touches, leftmost first and
the longer form before the single word.  All labelers vote on candidates and base
spans: formats (regular expressions), word lists (gazetteer) in and around the span,
the context and the shape.  Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is, without labels; its posteriors
train the final span classifier (naive Bayes over features of the span, some of
which no labeler sees), and the candidates that it accepts become ``other`` spans.

Votes and features are a few characters and bits for each candidate, so training
is one aggregate over all documents whose result is bounded by the number of
patterns (3 ** labelers * 2 ** features); nothing is sampled and no text is
shuffled.  Offsets are code points, end exclusive: the pieces between matches and
the matches themselves are laid end to end.  Patterns are possessive and anchored,
so long runs cost linear time and no recursion.

Native DataFrame functions only.

Defined cases: a null or empty text has no spans; equal rows get equal results;
without candidates, or with votes for one class only, no span is added; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import stage_table, text_of

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns.  A match may begin after a character of its own first
# class only right behind the match before, as leftmost search has it.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have before a pattern is tried.
NEEDS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
EDGES = ".,;:!?()[]{}<>\"'"

# Word lists of the gazetteer labeler (lower case).
PERSONAL_WORDS = ("phone", "tel", "telefon", "mobile", "fax", "call", "email", "e-mail", "mail", "courriel", "correo",
                  "contact", "address", "ssn", "passport", "iban", "account", "konto", "card", "password", "passwort",
                  "passwd", "pwd", "secret", "token", "key", "login", "user", "username", "born", "dob")
PLAIN_WORDS = ("version", "license", "licence", "apache", "cc", "by", "by-nc", "by-sa", "mit", "gpl", "bsd", "page",
               "chapter", "section", "figure", "table", "step", "part", "no", "nr", "vol", "about", "copyright")
# Formats that stand for personal data or secrets, and plain numbers.
PERSONAL_FORMAT = (r"^(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|AKIA[0-9A-Z]{16}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"
                   r"|(?:gh[pousr]_|sk-|xox[abp]-)[A-Za-z0-9_-]{16,}|(?i:password|passwd|pwd|secret|token|api_?key)[=:].+)$")
GROUPED_ACCOUNT = r"[A-Z]{2}[0-9]{2}(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"
LOCAL_PHONE = r"(?:\([0-9]{2,5}\)\x20?|[0-9]{3}[.-])[0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9A-Za-z])"
BARE_KEY = r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
# Words before a name, first names, words of streets.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Herrn", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Señora", "Sr", "Sra", "Don", "Doña")
FIRST_NAMES = ("James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda", "David", "Elizabeth", "William", "Barbara",
               "Richard", "Susan", "Thomas", "Sarah", "Peter", "Anna", "Hans", "Klaus", "Wolfgang", "Jürgen", "Ursula", "Sabine", "Monika",
               "Petra", "Jean", "Pierre", "Michel", "Marie", "Nathalie", "Isabelle", "François", "José", "Antonio", "Manuel", "Francisco",
               "Carmen", "María", "Josefa", "Isabel", "Dolores", "Juan", "Carlos")
STREETS = ("Street", "Road", "Avenue", "Lane", "Drive", "Boulevard")
STREETS_BEFORE = ("rue", "avenue", "boulevard", "calle", "avenida", "plaza")
STREETS_JOINED = ("straße", "strasse", "weg", "platz", "gasse", "allee")
PLAIN_FORMAT = r"^[v#§$€£]?[0-9]{1,4}(?:[.,:/-][0-9]{1,4}){0,2}(?:st|nd|rd|th|%|s)?$"

# --- what labelers propose --------------------------------------------------

_NAME = r"\p{Lu}\p{Ll}++(?:-\p{Lu}\p{Ll}++)?+"
LISTED = (rf"(?:(?:{'|'.join(TITLES)})\.?+\x20{_NAME}(?:\x20{_NAME})?+|(?:{'|'.join(FIRST_NAMES)})\x20{_NAME}"
          rf"|[0-9]{{1,5}}\x20{_NAME}(?:\x20{_NAME})?\x20(?:{'|'.join(STREETS)})(?![\p{{L}}])"
          rf"|[0-9]{{1,4}}+,?+\x20(?:{'|'.join(STREETS_BEFORE)})\x20(?:[\p{{L}}]{{1,20}}\x20){{0,2}}{_NAME}"
          rf"|\p{{Lu}}\p{{Ll}}{{2,30}}(?:{'|'.join(STREETS_JOINED)})\x20[0-9]{{1,4}}[a-z]?+(?![0-9\p{{L}}]))")
# look-aheads of one character come first: most places fail there
_ASSIGNING = r"(?<=(?i:password|passwort|passwd|pwd|secret|token|key|login|username)\x20?[=:]"
ASSIGNED = rf"(?<=[=:]\x20?){_ASSIGNING}\x20?)[^\x20\x09-\x0D]++"
_WORD_START = r"(?<![^\x20\x09-\x0D\"'<\[(])"
CANDIDATE_RE = (rf"(?=[\p{{Lu}}0-9(]){_WORD_START}(?:{GROUPED_ACCOUNT}|{LOCAL_PHONE}|{BARE_KEY}|{LISTED})|{ASSIGNED}"
                r"|(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@=]*+[0-9@=][^\x20\x09-\x0D]*+")
#: What a text must have before candidates are looked for.
CANDIDATE_NEEDS = rf"[0-9@=]|:{_ASSIGNING})|(?=[A-Z])(?:AKIA|(?:{'|'.join(TITLES + FIRST_NAMES)})[.\x20])"


# --- base spans -------------------------------------------------------------

def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    at = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(at, F.lit(0), lambda s, i: s + _luhn_digit(F.substring(digits, -i, F.lit(1)).cast("int"), i))
    return total % 10 == 0


def _luhn_digit(d: Column, i: Column) -> Column:
    return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)


def _holds(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)


def _placed(text: Column, pattern: str) -> Column:
    """Array of (start, m, before, after) for the leftmost non-overlapping matches."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    both = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))
    starts = F.aggregate(both, start, lambda a, x: F.struct(
        (a["at"] + x.g + x.m).alias("at"), F.array_append(a.starts, a["at"] + x.g).alias("starts")), lambda a: a.starts)
    parts = F.arrays_zip(starts.alias("start"), found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("before"),
                         F.slice(gaps, F.lit(2), F.size(found)).alias("after"))
    return F.transform(parts, lambda x: F.struct(x.start.alias("start"), x.m.alias("m"), F.right(x.before, F.lit(40)).alias("before"),
                                                 F.left(x.after, F.lit(20)).alias("after")))


_SPANS = "array<struct<start:int,m:string,before:string,after:string>>"


def base_spans(text: Column, kind: str) -> Column:
    none = F.array().cast(_SPANS)
    return F.when(text.rlike(NEEDS[kind]), F.filter(_placed(text, PATTERNS[kind]), lambda x: _holds(kind, x.m))).otherwise(none)


# --- labelers and features --------------------------------------------------

def _last_words(before: Column) -> Column:
    return F.split(F.lower(F.regexp_replace(before, r"[^\p{L}\p{N}\x20-]+", " ")), " +")


def _vote(personal: Column, plain: Column) -> Column:
    return F.when(personal, "p").when(plain, "n").otherwise("-")


def labelers(x: Column) -> list[Column]:
    """Votes on a span (m, before, after, base): ``p``, ``n`` or ``-``."""
    near = F.slice(F.reverse(_last_words(x.before)), 1, 4)
    n_digits = F.length(F.regexp_replace(x.m, "[^0-9]", ""))
    return [
        _vote(x.base | x.m.rlike(PERSONAL_FORMAT) | x.m.rlike(f"^(?:{GROUPED_ACCOUNT}|{LOCAL_PHONE})$"), x.m.rlike(PLAIN_FORMAT)),  # format
        _vote(F.arrays_overlap(near, F.array(*map(F.lit, PERSONAL_WORDS))) | F.lower(x.m).rlike(r"^\p{L}+[=:]") | x.m.rlike(f"^{LISTED}$"),
              F.arrays_overlap(near, F.array(*map(F.lit, PLAIN_WORDS)))),  # gazetteer
        _vote(x.before.rlike(r"[:=<(]\s*$") | x.m.contains("=") | x.m.contains("@"), x.after.rlike(r"^[.,]?\s*$|^[.,]?\n")),  # context
        _vote((F.length(x.m) >= 9) & (n_digits >= 6), F.length(x.m) < 6),  # shape
    ]


def span_features(x: Column) -> list[Column]:
    """What the final classifier sees of a span."""
    return [F.length(x.m) >= 6, F.length(x.m) >= 10, F.length(x.m) >= 16, x.m.contains("@"), x.m.contains("="),
            x.m.rlike("[A-Za-z]"), x.m.rlike("[0-9].*[0-9].*[0-9].*[0-9].*[0-9]"), x.m.rlike("[A-Z].*[0-9]|[0-9].*[A-Z]"),
            x.m.contains(" "), x.m.rlike(f"^{LISTED}$")]


N_FEATURES = 10


# --- learning ---------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """Labelers' reliabilities, and the classifier's weights in log odds."""
    reliability: tuple[tuple[float, float], ...]
    bias: float
    weights: tuple[tuple[float, float], ...]

    def accepts(self, bits: Column) -> Column:
        score = F.lit(self.bias)
        for j, (off, on) in enumerate(self.weights):
            score = score + F.when(F.getbit(bits, F.lit(j)) == 1, on).otherwise(off)
        return score > 0


def fit(counts: list[tuple[str, int, int]], rounds: int = 50) -> Model | None:
    """EM over (votes, bits, count) for two classes with labelers that err
    independently, then naive Bayes on the posteriors."""
    by_votes: dict[str, int] = {}
    for votes, _, n in counts:
        by_votes[votes] = by_votes.get(votes, 0) + n
    if not any("p" in v for v in by_votes) or not any("n" in v for v in by_votes):
        return None
    k = len(next(iter(by_votes)))
    hit, prior = [(0.8, 0.8)] * k, 0.5  # chance of p if personal, of n if plain, where a labeler votes

    def posterior(votes: str) -> float:
        odds = math.log(prior / (1 - prior))
        for v, (a, b) in zip(votes, hit, strict=True):
            odds += math.log(a / (1 - b)) if v == "p" else math.log((1 - a) / b) if v == "n" else 0.0
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))

    for _ in range(rounds):
        q = {v: posterior(v) for v in by_votes}
        total = sum(by_votes.values())
        prior = (sum(n * q[v] for v, n in by_votes.items()) + 1) / (total + 2)
        new = []
        for j in range(k):
            pp, pn, np_, nn = 4.0, 1.0, 1.0, 4.0  # a weak belief that labelers are mostly right
            for v, n in by_votes.items():
                if v[j] == "p":
                    pp, np_ = pp + n * q[v], np_ + n * (1 - q[v])
                elif v[j] == "n":
                    pn, nn = pn + n * q[v], nn + n * (1 - q[v])
            new.append((pp / (pp + pn), nn / (nn + np_)))
        hit = new
    yes, no = [1.0] * N_FEATURES, [1.0] * N_FEATURES
    n_yes = n_no = 2.0
    for votes, bits, n in counts:
        q = posterior(votes)
        n_yes, n_no = n_yes + n * q, n_no + n * (1 - q)
        for j in range(N_FEATURES):
            if bits >> j & 1:
                yes[j] += n * q
                no[j] += n * (1 - q)
    weights = tuple((math.log((1 - y / n_yes) / (1 - x / n_no)), math.log((y / n_yes) / (x / n_no))) for y, x in zip(yes, no, strict=True))
    return Model(tuple(hit), math.log(n_yes / n_no), weights)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Model | None]:
    """One row per document row: id, ``base`` and ``spans`` as arrays of (k, start, end)
    in the order of kinds (email, ip, card, phone, other) and starts; and the model."""
    t = docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text"))
    t = t.select("id", "text", *[base_spans(F.col("text"), k).alias(k) for k in KINDS])
    words = F.when(F.col("text").rlike(CANDIDATE_NEEDS), _placed(F.col("text"), CANDIDATE_RE)).otherwise(F.array().cast(_SPANS))
    t = t.withColumn("words", words).drop("text")

    def span(x: Column, k: int) -> Column:
        return F.struct(F.lit(k).alias("k"), x.start.alias("start"), (x.start + F.length(x.m)).alias("end"),
                        x.m.alias("m"), x.before.alias("before"), x.after.alias("after"), F.lit(k < len(KINDS)).alias("base"))

    def tagged(k: int):
        return lambda x: span(x, k)

    def trimmed(x: Column) -> Column:
        core = F.when(x.m.rlike(r"^\([0-9]+\).*[0-9]"), x.m).otherwise(F.ltrim(x.m, F.lit(EDGES)))
        return F.struct((x.start + F.length(x.m) - F.length(core)).alias("start"), F.rtrim(core, F.lit(EDGES)).alias("m"),
                        x.before.alias("before"), x.after.alias("after"))

    t = t.select("id", F.concat(*[F.transform(k, tagged(n)) for n, k in enumerate(KINDS)]).alias("found"),
                 F.transform(F.filter(F.transform("words", trimmed), lambda x: x.m.rlike(r"[\p{L}\p{N}]")), tagged(len(KINDS))).alias("words"))
    free = F.filter("words", lambda w: ~F.exists("found", lambda b: (b.start < w.end) & (w.start < b.end)))
    t = t.withColumn("all", F.concat("found", free))

    def voted(x: Column) -> Column:
        bits = F.lit(0)
        for j, f in enumerate(span_features(x)):
            bits = bits + F.when(f, 1 << j).otherwise(0)
        return F.struct(x.k.alias("k"), x.start.alias("start"), x.end.alias("end"), F.concat(*labelers(x)).alias("votes"), bits.alias("bits"))

    rows = stage_table(t.select("id", F.transform("all", voted).alias("x")), "pii-candidates")
    counts = rows.select(F.explode("x").alias("x")).groupBy("x.votes", "x.bits").count()
    model = fit(sorted(map(tuple, counts.collect())))  # a row for each pattern of votes and features at most

    def plain(x: Column) -> Column:
        return F.struct(x.k.alias("k"), x.start.alias("start"), x.end.alias("end"))

    base = F.transform(F.filter("x", lambda x: x.k < len(KINDS)), plain)
    spans = F.transform(F.filter("x", lambda x: (x.k < len(KINDS)) | (model.accepts(x.bits) if model else F.lit(False))), plain)
    return rows.select(F.col("id").alias(id_col), base.alias("base"), spans.alias("spans")), model


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, (*KINDS, "other")))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.k), s.start, s.end)), ",")
