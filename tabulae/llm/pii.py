"""Personal data replaced by keyed surrogates [native].

E-mail addresses, telephone, card and social-security numbers, IP addresses
and titled names are found by patterns and replaced.  A surrogate is a keyed
function of the entity's canonical form, so every mention of an entity, in
whatever format, gets the same one; it keeps the kind, the script, the gender
and the mention's own format.  The distinct entities of all documents are
checked: two never share a surrogate, and no surrogate is another's original.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabulae.llm.common import let, written

ROUNDS = 40   # of re-drawing clashing surrogates; later ones are longer, so far fewer are needed
SAME_SIZE = {"email": 1, "ip": 6, "phone": 6, "card": 6, "ssn": 6}   # attempts before surrogates of the kind grow

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"   # possessive: a loop without a stack
IP = r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9A-Za-z]|\.[0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
CARD = r"(?<![0-9A-Za-z.+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
PHONE = r"(?<![0-9A-Za-z.+-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{4}(?![0-9A-Za-z])"
# Titles by gender.
WOMEN = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "г-жа", "госпожа"]
MEN = ["Mr", "Herr", "Señor", "Monsieur", "г-н", "господин"]
TITLED = r"(?<!\p{L})(" + "|".join(WOMEN + MEN) + r")\.? (\p{Lu}[\p{L}'-]+)(?: (\p{Lu}[\p{L}'-]+))?"
PATTERN = "|".join((EMAIL, IP, SSN, CARD, PHONE))
MAY_HAVE = "[0-9@]|(?:" + "|".join(WOMEN + MEN) + r")\.? \p{Lu}"
# Syllables of made-up names, sixteen a script, and endings by gender.
SYLLABLES = {"latin": "ba ce di fo gu ha je ki lo mu na pe ri so tu ve".split(), "cyrillic": "ба ве ги до жу за ке ли мо ну па ре си то фу хе".split()}
ENDINGS = {"latin": {"given_f": "na", "given_m": "n", "surname": "rd"}, "cyrillic": {"given_f": "на", "given_m": "н", "surname": "ко"}}


def hex_stream(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """128 keyed hexadecimal digits for an entity and an attempt."""
    seed = F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"))
    return F.concat(F.sha2(F.concat(seed, F.lit("|0")), 256), F.sha2(F.concat(seed, F.lit("|1")), 256))


def draw(stream: Column, i: Column, below: int) -> Column:
    """The i-th number from the stream, 0 up to ``below`` (the stream is used round and round)."""
    return (F.conv(F.substring(stream, F.pmod(i, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int") % below).cast("int")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _swapped(stream: Column, text: Column) -> Column:
    """ASCII letters become letters and digits digits; the rest stays."""
    return F.array_join(F.transform(_chars(text), lambda c, i: F.when(c.rlike("[a-z]"), F.char(F.lit(97) + draw(stream, i, 26)))
                                    .when(c.rlike("[0-9]"), draw(stream, i, 10).cast("string")).otherwise(c)), "")


def _card(stream: Column, canon: Column) -> Column:
    """First digit kept, then drawn digits, last the check digit of the Luhn rule."""
    body = F.transform(F.sequence(F.lit(0), F.length(canon) - 2), lambda i: F.when(i == 0, F.substring(canon, 1, 1).cast("int")).otherwise(draw(stream, i, 10)))

    def checked(b: Column) -> Column:
        doubled = F.transform(b, lambda d, i: F.when((F.size(b) - i) % 2 == 1, F.when(d >= 5, 2 * d - 9).otherwise(2 * d)).otherwise(d))
        total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
        return F.concat(F.array_join(F.transform(b, lambda d: d.cast("string")), ""), ((10 - total % 10) % 10).cast("string"))

    return let(body, checked)


def _name(stream: Column, kind: Column, canon: Column, attempt: Column) -> Column:
    """Syllables of the name's script with the ending of its kind; later attempts are longer."""
    def in_script(script: str) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.lit(3) + attempt), lambda i: F.element_at(F.array(*map(F.lit, SYLLABLES[script])), draw(stream, i, 16) + 1))
        ending = reduce(lambda a, k: F.when(kind == k, F.lit(ENDINGS[script][k])).otherwise(a), ENDINGS[script], F.lit(""))
        return F.concat(F.array_join(parts, ""), ending)

    return F.when(canon.rlike(r"^\p{IsCyrillic}"), in_script("cyrillic")).otherwise(in_script("latin"))


def surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """Canonical form of the entity's surrogate."""
    def more(s: Column, name: str, below: int, sign) -> Column:
        """Further signs in front on later attempts: a format with few surrogates has enough then."""
        extra = F.slice(F.sequence(F.lit(0), F.greatest(attempt - SAME_SIZE[name], F.lit(0))), 2, ROUNDS)      # 1, 2, ... or empty
        return F.array_join(F.transform(extra, lambda i: sign(draw(s, i + 7, below))), "")

    def letter(n: Column) -> Column:
        return F.char(F.lit(97) + n)

    def digit(n: Column) -> Column:
        return n.cast("string")

    def drawn(s: Column) -> Column:
        ip = F.concat_ws(".", *(((draw(s, F.lit(i), 254) + 1).cast("string")) for i in range(4)))
        port = F.regexp_replace(more(s, "ip", 10, digit), "^(?=.)", ":1")
        host = F.regexp_extract(canon, r"^(.*)(\.[^.]*)$", 1)
        return (F.when(kind == "email", F.concat(more(s, "email", 26, letter), _swapped(s, host), F.regexp_extract(canon, r"(\.[^.]*)$", 1)))
                .when(kind == "ip", F.concat(ip, port))
                .when(kind == "card", F.concat(more(s, "card", 10, digit), _card(s, canon)))
                .when(kind.isin("phone", "ssn"), F.concat(more(s, "phone", 10, digit), _swapped(s, canon)))
                .otherwise(_name(s, kind, canon, attempt)))

    return let(hex_stream(key, kind, canon, attempt), drawn)


def names_of(text: Column) -> Column:
    """Name words of the titled names: array of struct(word, kind)."""
    groups = F.arrays_zip(*(F.regexp_extract_all(text, F.lit(TITLED), F.lit(g)).alias(f"g{g}") for g in (1, 2, 3)))

    def words(g: Column) -> Column:
        given = F.when(g["g1"].isin(WOMEN), F.lit("given_f")).otherwise(F.lit("given_m"))
        whole = F.array(F.struct(g["g2"].alias("word"), given.alias("kind")), F.struct(g["g3"].alias("word"), F.lit("surname").alias("kind")))
        return F.when(F.coalesce(g["g3"], F.lit("")) != "", whole).otherwise(F.array(F.struct(g["g2"].alias("word"), F.lit("surname").alias("kind"))))

    return F.array_distinct(F.flatten(F.transform(groups, words)))


def pieces_of(text: Column, names: Column) -> Column:
    """The text in pieces: plain at even places, entities at odd ones.

    Entities are framed by a mark that holds a digest of the text, so no text
    contains its own mark.
    """
    # The longest first: a name that begins a double-barrelled one must not take its first half.
    longest = F.transform(F.array_sort(F.transform(names, lambda n: F.struct((-F.length(n["word"])).alias("size"), n["word"].alias("word")))), lambda n: n["word"])
    mentions = F.concat(F.lit(PATTERN + r"|(?<!\p{L})(?:"), F.array_join(F.transform(longest, lambda w: F.concat_ws("|", w, F.upper(w))), "|"), F.lit(r")(?!\p{L})"))
    pattern = F.when(F.size(names) > 0, mentions).otherwise(F.lit(PATTERN))
    mark = F.concat(F.lit("\ue000"), F.substring(F.sha2(text, 256), 1, 16))
    return let(mark, lambda m: F.split(F.regexp_replace(text, F.concat(F.lit("("), pattern, F.lit(")")), F.concat(m, F.lit("$1"), m)), m))


def entity(piece: Column, names: Column) -> Column:
    """struct(kind, canon) of an entity as written."""
    digits = F.regexp_replace(piece, "[^0-9]", "")
    named = F.get(F.filter(names, lambda n: (n["word"] == piece) | (F.upper(n["word"]) == piece)), F.lit(0))["kind"]
    kind = (F.when(piece.contains("@"), F.lit("email")).when(piece.rlike(f"^(?:{IP})$"), F.lit("ip"))
            .when(piece.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.lit("ssn")).when(piece.rlike("^[0-9][0-9 -]+$") & (F.length(digits) >= 13), F.lit("card"))
            .when(piece.rlike("[0-9]"), F.lit("phone")).otherwise(named))
    # A telephone number is its last ten digits, with or without the country in front.
    canon = F.when(kind == "phone", F.right(digits, F.lit(10))).when(kind.isin("card", "ssn"), digits).otherwise(F.lower(piece))
    return F.struct(kind.alias("kind"), canon.alias("canon"))


def dressed(kind: Column, piece: Column, made: Column) -> Column:
    """The surrogate in the format of the mention; what a longer one has more goes in front (addresses: at the end)."""
    def digit(i: Column) -> Column:      # the k-th digit from the right is the surrogate's k-th from the right
        k = F.length(F.regexp_replace(F.substring(piece, i + 1, F.length(piece)), "[^0-9]", ""))
        return F.when(k <= own, F.substring(made, F.length(made) - k + 1, F.lit(1))).otherwise(F.substring(piece, i + 1, F.lit(1)))

    digits = F.length(F.regexp_replace(piece, "[^0-9]", ""))
    own = F.when(kind == "phone", F.least(digits, F.lit(10))).otherwise(digits)      # digits of the canonical form
    longer = F.substring(made, F.lit(1), F.greatest(F.length(made) - own, F.lit(0)))
    numbers = F.concat(longer, F.array_join(F.transform(_chars(piece), lambda c, i: F.when(c.rlike("[0-9]"), digit(i)).otherwise(c)), ""))
    # sign by sign from arrays: long addresses take linear time
    cased = let(_chars(made), lambda m: F.concat(
        F.array_join(F.transform(_chars(piece), lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(F.get(m, i))).otherwise(F.get(m, i))), ""),
        F.substring(made, F.length(piece) + 1, F.length(made))))
    name = F.when(piece == F.upper(piece), F.upper(made)).otherwise(F.initcap(made))
    return F.when(kind == "email", cased).when(kind == "ip", made).when(kind.isin("phone", "card", "ssn"), numbers).otherwise(name)


def found(text: Column) -> Column:
    """struct(pieces, names) of a text that may hold an entity, else null."""
    whole = let(names_of(text), lambda n: F.struct(pieces_of(text, n).alias("pieces"), n.alias("names")))
    return F.when(text.rlike(MAY_HAVE), whole)


def entities(docs: DataFrame, *more: Column) -> DataFrame:
    """Distinct (kind, canon) of all documents, with the further columns given."""
    at = docs.select(*more, found(F.col("text")).alias("__f")).where(F.size("__f.pieces") > 1)
    odd = F.filter(F.col("__f.pieces"), lambda _p, i: i % 2 == 1)
    every = at.select(*(c for c in at.columns if c != "__f"), F.explode(F.array_distinct(F.transform(odd, lambda p: entity(p, F.col("__f.names"))))).alias("e"))
    return every.select(*(c for c in at.columns if c != "__f"), "e.kind", "e.canon").distinct()


def resolved(known: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt) of the entities whose first surrogate clashes.

    A surrogate is taken if it is an original of its kind or if an entity
    earlier in order drew it; those that lose draw again until all differ.
    """
    drawn = known.withColumn("attempt", F.lit(0))
    for _ in range(ROUNDS):
        drawn = written(drawn.withColumn("made", surrogate(key, F.col("kind"), F.col("canon"), F.col("attempt"))), "surrogates")
        order = Window.partitionBy("kind", "made").orderBy("attempt", "canon")
        shared = drawn.groupBy("kind", "made").agg(F.count("*").alias("n")).where("n > 1").select("kind", "made")
        later = drawn.join(shared, ["kind", "made"]).withColumn("place", F.row_number().over(order)).where("place > 1").select("kind", "canon")
        originals = known.select("kind", F.col("canon").alias("made"))
        lost = written(later.union(drawn.join(originals, ["kind", "made"], "left_semi").select("kind", "canon")).distinct().withColumn("lost", F.lit(1)), "clashes")
        if lost.isEmpty():
            return drawn.where("attempt > 0").drop("made")
        drawn = drawn.drop("made").join(lost, ["kind", "canon"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("lost", F.lit(0))).drop("lost")
    raise ValueError(f"surrogates still clash after {ROUNDS} rounds: too many entities of a kind for its format")


def rewritten(text: Column, key: str, again: Column) -> Column:
    """struct(text, n) with the entities replaced; ``again``: array of (kind, canon, attempt)."""
    def piece(p: Column, i: Column, names: Column) -> Column:
        def replaced(e: Column) -> Column:
            attempt = F.coalesce(F.get(F.filter(again, lambda a: (a["kind"] == e["kind"]) & (a["canon"] == e["canon"])), F.lit(0))["attempt"], F.lit(0))
            # each evaluated once: a surrogate takes two digests, and is looked at sign by sign
            made = let(attempt, lambda a: surrogate(key, e["kind"], e["canon"], a))
            return let(made, lambda m: dressed(e["kind"], p, m))
        return F.when(i % 2 == 1, let(entity(p, names), replaced)).otherwise(p)

    def whole(f: Column) -> Column:
        new = F.array_join(F.transform(f["pieces"], lambda p, i: piece(p, i, f["names"])), "")
        n = F.floor(F.size(f["pieces"]) / 2).cast("long")
        return F.when(f.isNull() | (F.size(f["pieces"]) <= 1), F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))).otherwise(
            F.struct(new.alias("text"), n.alias("n")))

    return let(found(text), whole)


def replace_personal_data(docs: DataFrame, key: str = "surrogate-key-1") -> DataFrame:
    """``docs`` with the text rewritten and a column n_replaced (mentions).

    Texts without personal data, null and empty ones stay as they are.  All
    other columns are carried along; a column n_replaced that is there already
    is replaced.  Repeated rows get equal texts; an empty table gives no row.
    One pass gathers the distinct entities; the rewriting pass is map-only
    unless some surrogates clashed, when the texts that hold those entities
    are given their redrawn attempts by a join.
    """
    again = written(resolved(written(entities(docs), "entities"), key), "redrawn")
    kind = "array<struct<kind:string,canon:string,attempt:int>>"
    if again.isEmpty():
        rows = docs.withColumn("__again", F.lit(None).cast(kind))
    else:
        digest = F.xxhash64("text")
        # Written first: its size is then known, and a small table spares the texts a shuffle.
        held = written(entities(docs, digest.alias("__digest")).join(again, ["kind", "canon"]).groupBy("__digest").agg(
            F.collect_list(F.struct("kind", "canon", "attempt")).alias("__again")), "held")
        rows = docs.join(held.withColumnRenamed("__digest", "__own"), F.xxhash64("text") == F.col("__own"), "left").drop("__own")
    done = rows.withColumn("__new", rewritten(F.col("text"), key, F.col("__again")))
    return done.withColumns({"text": F.col("__new.text"), "n_replaced": F.col("__new.n")}).drop("__new", "__again")
