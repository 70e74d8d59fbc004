"""Personal data by weak supervision, in DataFrame expressions only.

Format matches give the base spans. They and looser candidates (local phone numbers, spelled-out
addresses of mail, cards and numbers in other groupings) are then voted on by labelers: the strict
format (regex), gazetteers of number ranges and domain ends, the words before the span (context), and
the characters around it, which can only speak against it. Votes are counted by pattern over the whole corpus; expectation-maximisation on those
counts estimates, per kind, how common true spans are and how reliable each labeler is. Its
posteriors are the soft labels on which a naive Bayes span classifier is trained over span features,
again by counting. A candidate is added if the classifier finds it more likely than not and it does
not overlap a base span; base spans always stay.

Candidates are found once per text and stored; everything after works on them inside their row.
What is gathered is one row per vote pattern and one per feature value, both bounded by the
labelers and features below, not by the data.

Positions are code points, ends exclusive. Defined cases: null and empty texts have no spans; null
and repeated ids are rows of their own; a corpus without candidates gives empty spans; extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import stored

KINDS = ("email", "ip", "card", "phone")

# The base formats are fixed by the contract. Each starts where a run of its characters starts or
# where the match before ended (\G), which finds the same matches without trying every character of
# a long run; repeated parts are possessive where the next character can't belong to them.
LOCAL = r"A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Card numbers: runs of digits, spaces and hyphens, then cut at two separators in a row.
DIGIT_RUN = r"[0-9][0-9\x20-]{10,}[0-9]"
RUN_CUT = r"[\x20-]{2,}"
# Looser candidates.
LOCAL_PHONE = r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9.-])"
SPELLED_EMAIL = (
    r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64}(?: \[at\] | \(at\) | AT )[A-Za-z0-9-]{2,63}"
    r"(?: \[dot\] | \(dot\) | DOT |\.)[A-Za-z]{2,10}(?![A-Za-z])"
)

# Gazetteers: plain lists of well-known values.
DOMAIN_ENDS = "com org net edu gov io de fr es it uk eu ch at nl info biz example".split()
CARD_STARTS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"
PRIVATE_NETS = r"^(?:10\.|127\.|192\.168\.|0\.|255\.)"
CUES = {
    "email": "email e-mail mail contact write correo courriel",
    "ip": "ip host server address addr client adresse",
    "card": "card visa mastercard credit debit karte carte tarjeta",
    "phone": "phone tel telephone call mobile fax telefon teléfono téléphone",
}
WRONG_CUES = "isbn issn version order invoice id no sku serial page art doi".split()

VOTES = ("format", "gazetteer", "context", "border")
EM_ROUNDS = 25
THRESHOLD = 0.5


def _sequence_starts(lengths: Column) -> Column:
    """Running sums of an array, each before its own element."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(
        lengths,
        zero,
        lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")
        ),
        lambda acc: acc["starts"],
    )


def spans(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as array of (start, end, found).

    The gaps between matches (a split) and the matches alternate, so a match starts at the lengths
    of all gaps up to it and all matches before it.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    starts = _sequence_starts(
        F.transform(pairs, lambda p: F.length(p["g"]) + F.length(p["m"]))
    )
    found = F.zip_with(
        pairs,
        starts,
        lambda p, s: F.struct(
            (s + F.length(p["g"])).alias("start"),
            (s + F.length(p["g"]) + F.length(p["m"])).alias("end"),
            p["m"].alias("found"),
        ),
    )
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(none)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where the check digit of a digit string holds."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(
            (d.try_cast("int") * 2) % 10 + F.when(d.try_cast("int") >= 5, 1).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _card_pieces(text: Column) -> Column:
    """Maximal runs of digits with single separators, 12 digits or more."""
    runs = spans(text, DIGIT_RUN)
    pieces = F.flatten(
        F.transform(
            runs,
            lambda r: F.transform(
                _pieces_of(r["found"]),
                lambda p: F.struct(
                    (r["start"] + p["start"]).alias("start"),
                    (r["start"] + p["end"]).alias("end"),
                    p["found"].alias("found"),
                ),
            ),
        )
    )
    return F.filter(pieces, lambda p: F.length(_digits(p["found"])) >= 12)


def _pieces_of(run: Column) -> Column:
    parts = F.split(run, RUN_CUT, -1)
    cuts = F.concat(F.regexp_extract_all(run, F.lit(RUN_CUT), F.lit(0)), F.array(F.lit("")))
    pairs = F.zip_with(parts, cuts, lambda p, c: F.struct(p.alias("p"), c.alias("c")))
    starts = _sequence_starts(F.transform(pairs, lambda x: F.length(x["p"]) + F.length(x["c"])))
    return F.zip_with(
        pairs,
        starts,
        lambda x, s: F.struct(
            s.alias("start"), (s + F.length(x["p"])).alias("end"), x["p"].alias("found")
        ),
    )


def _sign(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0)).cast("tinyint")


def _candidate(kind: str, text: Column, span: Column, base: Column) -> Column:
    """A span with its votes and features."""
    found = span["found"]
    before = F.lower(F.substring(text, F.greatest(span["start"] - 23, F.lit(1)), F.least(span["start"], F.lit(24))))
    cue = F.regexp_extract(before, r"([\p{L}-]+)[^\p{L}]{0,4}$", 1)
    after = F.substring(text, span["end"] + 1, F.lit(1))
    previous = F.when(span["start"] == 0, F.lit("")).otherwise(F.substring(text, span["start"], F.lit(1)))
    open_border = previous.rlike(r"^[\s(\[<\"':,;=]?$") & after.rlike(r"^[\s)\]>\"'.,;:!?%#*$&|]?$")
    digits = _digits(found)
    end = F.lower(F.regexp_extract(found, r"([A-Za-z0-9-]+)$", 1))
    named = end.isin(DOMAIN_ENDS)
    net = found.rlike(PRIVATE_NETS)
    start_ok = digits.rlike(CARD_STARTS)
    gazetteer = {
        "email": _sign(named, ~end.rlike("^[a-z]{2,10}$")),
        "ip": _sign(~net, net),
        "card": _sign(start_ok, ~start_ok),
        "phone": _sign(found.startswith("+") | found.startswith("("), F.length(digits) < 9),
    }[kind]
    context = _sign(cue.isin(CUES[kind].split()), cue.isin(WRONG_CUES))
    shape = F.concat_ws(
        "/",
        F.least(F.length(digits), F.lit(20)).cast("string"),
        F.when(found.contains(" "), "s").otherwise(""),
        F.when(found.contains("-"), "h").otherwise(""),
        F.when(found.contains("("), "p").otherwise(""),
    )
    features = F.array(
        F.concat(F.lit("shape="), shape),
        F.concat(F.lit("cue="), F.when(context > 0, "yes").when(context < 0, "no").otherwise("other")),
        F.concat(F.lit("before="), _class_of(previous)),
        F.concat(F.lit("after="), _class_of(after)),
        F.concat(F.lit("gazetteer="), gazetteer.cast("string")),
    )
    return F.struct(
        span["start"].alias("start"),
        F.lit(KINDS.index(kind)).alias("kind"),
        span["end"].alias("end"),
        base.alias("base"),
        F.array(_sign(base, ~base), gazetteer, context, _sign(F.lit(False), ~open_border)).alias("votes"),
        features.alias("features"),
    )


def _class_of(character: Column) -> Column:
    return (
        F.when(character == "", "edge")
        .when(character.rlike(r"^\s"), "space")
        .when(character.rlike(r"^\p{L}"), "letter")
        .when(character.rlike(r"^[0-9]"), "digit")
        .otherwise("mark")
    )


CANDIDATE = (
    "array<struct<start:int,kind:int,end:int,base:boolean,votes:array<tinyint>,features:array<string>>>"
)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and all candidate spans of its text with votes and features, per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lists = docs.select(
        F.col("doc_id"),
        text.alias("text"),
        spans(text, EMAIL).alias("email"),
        spans(text, IP).alias("ip"),
        _card_pieces(text).alias("card"),
        spans(text, PHONE).alias("phone"),
        spans(text, LOCAL_PHONE).alias("local_phone"),
        spans(text, SPELLED_EMAIL).alias("spelled_email"),
    )
    yes, no = F.lit(True), F.lit(False)
    octets = lambda s: F.forall(
        F.split(s["found"], r"\."),
        lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
        & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255),
    )
    card_ok = lambda s: (F.length(_digits(s["found"])) <= 19) & luhn(_digits(s["found"]))
    phone_ok = lambda s: F.length(_digits(s["found"])).between(9, 15)
    t = F.col("text")
    each = [
        F.transform("email", lambda s: _candidate("email", t, s, yes)),
        F.transform(F.filter("ip", octets), lambda s: _candidate("ip", t, s, yes)),
        F.transform(
            F.filter("card", lambda s: F.length(_digits(s["found"])) <= 19),
            lambda s: _candidate("card", t, s, card_ok(s)),
        ),
        F.transform(F.filter("phone", phone_ok), lambda s: _candidate("phone", t, s, yes)),
        F.transform("local_phone", lambda s: _candidate("phone", t, s, no)),
        F.transform("spelled_email", lambda s: _candidate("email", t, s, no)),
    ]
    return lists.select("doc_id", F.concat(*each).cast(CANDIDATE).alias("found"))


def _log_odds(p: Column) -> Column:
    return F.ln(p / (1 - p))


def _posterior(prior: Column, reliability: Column, votes: Column) -> Column:
    """Probability that a span is true, given its votes: labelers err independently."""
    weight = F.aggregate(
        F.zip_with(votes, reliability, lambda v, r: v.cast("double") * _log_odds(r)),
        F.lit(0.0),
        lambda a, x: a + x,
    )
    return 1 / (1 + F.exp(-(_log_odds(prior) + weight)))


def _reliability(j: int, post, total) -> Column:
    """How often labeler ``j`` agrees with the posteriors where it votes.

    It is taken to be better than chance: four of five right, as ten earlier votes.
    """

    def right(x: Column) -> Column:
        vote = x["votes"][j]
        return x["n"] * F.when(vote > 0, post(x)).when(vote < 0, 1 - post(x)).otherwise(0.0)

    voted = total(lambda x: x["n"] * F.abs(x["votes"][j]).cast("double"))
    return F.least(F.greatest((total(right) + 8) / (voted + 10), F.lit(0.5)), F.lit(0.95))


def reliabilities(found: DataFrame, rounds: int = EM_ROUNDS) -> DataFrame:
    """kind, prior and reliability per labeler, by expectation-maximisation.

    Works on counts per vote pattern (at most 3 to the number of labelers for each kind), all of a
    kind in one row: each round folds over that row.
    """
    counted = (
        found.select(F.inline("found"))
        .groupBy("kind", "votes")
        .agg(F.count("*").cast("double").alias("n"))
        .groupBy("kind")
        .agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
    )
    p = F.col("patterns")

    def total(of):
        return F.aggregate(F.transform(p, of), F.lit(0.0), lambda a, x: a + x)

    def step(state: Column, _: Column) -> Column:
        post = lambda x: _posterior(state["prior"], state["reliability"], x["votes"])
        prior = (total(lambda x: x["n"] * post(x)) + 1) / (total(lambda x: x["n"]) + 2)
        each = [_reliability(j, post, total) for j in range(len(VOTES))]
        return F.struct(
            F.least(F.greatest(prior, F.lit(0.001)), F.lit(0.999)).alias("prior"),
            F.array(*each).alias("reliability"),
        )

    start = F.struct(
        F.lit(0.5).alias("prior"), F.array(*[F.lit(0.8)] * len(VOTES)).alias("reliability")
    )
    state = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
    return counted.select("kind", state.alias("s")).select("kind", "s.prior", "s.reliability")


def classifier(found: DataFrame, learned: DataFrame) -> DataFrame:
    """kind, feature, weight: a naive Bayes span classifier trained on the posteriors.

    The feature "" holds the prior log odds of the kind.
    """
    table = _as_map(learned.select("kind", F.struct("prior", "reliability").alias("value")))
    spans_ = found.select(F.inline("found")).withColumn("learned", table)
    odds = spans_.select(
        "kind",
        "features",
        _posterior(
            F.col("learned")[F.col("kind")]["prior"],
            F.col("learned")[F.col("kind")]["reliability"],
            F.col("votes"),
        ).alias("p"),
    )
    named = odds.select("kind", "p", F.explode(F.concat(F.array(F.lit("")), "features")).alias("feature"))
    sums = named.groupBy("kind", "feature").agg(
        F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")
    )
    own = F.ln((F.col("yes") + 1) / (F.col("no") + 1))
    base = F.ln((F.col("all_yes") + 1) / (F.col("all_no") + 1))
    alls = sums.where("feature = ''").select("kind", F.col("yes").alias("all_yes"), F.col("no").alias("all_no"))
    return sums.join(alls, "kind").select(
        "kind", "feature", F.when(F.col("feature") == "", base).otherwise(own - base).alias("weight")
    )


def _as_map(pairs: DataFrame) -> Column:
    """A small two-column table (key, value) as a map in every row, by a scalar subquery."""
    key, value = pairs.columns
    one = pairs.agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m"))
    return one.scalar()


def personal_data(docs: DataFrame, threshold: float = THRESHOLD, carry: tuple[str, ...] = ()):
    """doc_id and ``spans``, array of (start, kind number, end, base), of every row."""
    return spans_of(stored(candidates(docs), "candidates"), threshold)


def spans_of(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    learned = stored(reliabilities(found), "reliabilities")
    weights = stored(
        classifier(found, learned).select(
            F.concat_ws(":", F.col("kind").cast("string"), "feature").alias("name"), "weight"
        ),
        "weights",
    )
    table = _as_map(weights)
    scored = found.withColumn("weights", table)

    def likely(s: Column) -> Column:
        name = lambda f: F.concat_ws(":", s["kind"].cast("string"), f)
        score = F.aggregate(
            s["features"],
            F.coalesce(F.col("weights")[name(F.lit(""))], F.lit(0.0)),
            lambda a, f: a + F.coalesce(F.col("weights")[name(f)], F.lit(0.0)),
        )
        return 1 / (1 + F.exp(-score)) > threshold

    base = F.filter("found", lambda s: s["base"])
    loose = F.filter("found", lambda s: ~s["base"])
    added = F.filter(
        loose,
        lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        & likely(s),
    )
    short = lambda s: F.struct(s["start"], s["kind"], s["end"], s["base"])
    return scored.select(
        *[c for c in found.columns if c != "found"],
        F.sort_array(F.transform(F.concat(base, added), short)).alias("spans"),
    )


def listed(spans_: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(
        F.transform(
            spans_,
            lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_of(kind: str, spans_: Column) -> Column:
    """How many spans are of a kind."""
    # One parameter only: F.filter gives a second one the element's place in the array.
    return F.size(F.filter(spans_, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans_: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    name = lambda s: F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), s["kind"] + 1)

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], gap, name(s))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(
        spans_,
        start,
        step,
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )


def redact(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of ``docs`` with personal data replaced in ``text``.

    n_chars, where there is such a column, follows the text.
    """
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("doc_id"), F.col("text")
    )
    found = stored(candidates(rows), "candidates")
    marked = spans_of(found, threshold).withColumnRenamed("doc_id", "row")
    text = F.when(F.size("spans") > 0, redacted(F.col("row.text"), F.col("spans")))
    done = marked.withColumn("new_text", text)
    out = []
    for n in names:
        if n == "text":
            out.append(F.coalesce("new_text", F.col("row.text")).alias(n))
        elif n == "n_chars":
            kind = docs.schema[n].dataType
            out.append(F.coalesce(F.length("new_text"), F.col("row.n_chars")).cast(kind).alias(n))
        else:
            out.append(F.col(f"row.`{n}`").alias(n))
    return done.select(*out)
