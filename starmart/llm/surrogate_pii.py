"""Personal data replaced by surrogates of the same kind and format.

Entities are found by patterns: e-mail addresses, IBANs, access keys and tokens, card numbers, social security numbers,
IPv4 addresses, telephone numbers, and names after a form of address. A surrogate is drawn from a keyed hash of kind and
value, so one value gets the same surrogate everywhere (coreference; the parts of a name and the domains of addresses
are entities of their own). It keeps the format: digits become digits and letters become letters of the same case,
check digits of cards and IBANs hold where they held, octets stay octets, a given name keeps its gender and a name its
script. All distinct values of the corpus are checked: where two values drew the same surrogate, or a surrogate is
itself a value of the corpus, one draws again, until no two agree.

Given and family names are of one kind: a name gets one surrogate wherever it stands. Its gender is that of the forms of
address it follows anywhere in the corpus, or is told by its ending where they disagree or tell none; a name that stands
before another one anywhere is a given name. Where a document names somebody after a form of address, the same names are
replaced in the rest of that document too, as whole words in the same case.

So that this ends where a format has fewer places than values, every fourth attempt of a value draws from a larger space:
names get longer, and local parts, first labels of domains, telephone, card and social security numbers, IBANs and
secrets get one more letter or digit each time (check digits still hold). IP addresses first let octets change their
digit count; were all addresses of four octets used up, they would get more octets.

Only documents with a digit, an ``@`` or a form of address are looked at closely. The table of surrogates is joined to the
values found and then, by a digest of the text, to these documents; it is never held whole anywhere.

Defined results: null and empty texts, and texts without entities, stay as they are; equal texts get equal results;
rows, ids and all other columns pass through unchanged; an empty table gives an empty result.
"""

from __future__ import annotations

import hmac
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from starmart.llm.common import releasing, stored
from starmart.llm.words import slices

#: Forms of address and the gender they tell (m, f, or n for either).
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "n", "Prof": "n", "Herr": "m", "Herrn": "m", "Frau": "f",
    "Monsieur": "m", "Madame": "f", "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f",
    "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
}
#: Endings of made-up given names by script and gender.
ENDINGS = {
    ("latin", "m"): "n s r l rt ld".split(), ("latin", "f"): "na ra lia nia tta sa".split(),
    ("cyrillic", "m"): "н м р л".split(), ("cyrillic", "f"): "на ла ря ня".split(),
    ("greek", "m"): "νος ρος λης μας".split(), ("greek", "f"): "να ρα λια νη".split(),
}
#: Syllables of made-up names by script.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no ra re ro sa se ta te to va ve wa".split(),
    "cyrillic": "ба бе бо ва ве го да де до ка ко ла ле ло ма ме мо на не но ра ре ро са се та те то".split(),
    "greek": "βα βε γα γο δα δε κα κε κο λα λε λο μα με μο να νε νο ρα ρε ρο σα σε τα τε το".split(),
}

NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
PATTERN = re.compile("|".join([
    r"(?P<email>(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})",
    r"(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w))",
    r"(?P<secret>(?<!\w)(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,64})(?!\w))",
    r"(?P<card>(?<![\w.+-])\d(?:[ -]?\d){12,18}(?!\w))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))",
    r"(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w]|[.-]\d))",
    r"(?P<intl>(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w))",
    rf"(?P<name>(?<!\w)(?P<title>{'|'.join(sorted(TITLES, key=len, reverse=True))})\.?[ ](?P<full>{NAME}(?:[ ]{NAME}){{0,2}}))",
]))
#: A word as names are told from each other.
WORD = re.compile(rf"(?<!\w){NAME}(?!\w)")
#: What a document must hold to be looked at closely, for Java; its digits are those of Python's ``\d`` in PATTERN.
TRIGGER = r"[\p{Nd}@]|" + "|".join(TITLES)


def script(text: str) -> str:
    first = next((c for c in text if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= first <= "ӿ" else "greek" if "Ͱ" <= first <= "Ͽ" else "latin"


def name_parts(full: str) -> list[tuple[int, int]]:
    """Capitalized words from the start on; another word or a form of address ends the name."""
    parts = []
    for word in re.finditer(NAME, full):
        if not word.group()[0].isupper() or word.group() in TITLES:
            break
        parts.append(word.span())
    return parts


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and hint of each entity, in order and apart from each other.

    The hint of a name is "m", "f" or "n" before another name, by the form of address, and "last" otherwise; a name
    that is only mentioned again has none.
    """
    found, names, place = [], set(), 0
    while match := PATTERN.search(text, place):
        start, place = match.start(), match.end()
        kind = next(k for k in ("email", "iban", "secret", "card", "ssn", "ip", "phone", "intl", "name") if match.group(k) is not None)
        if kind == "email":
            at = match.group().rindex("@")
            found += [(start, start + at, "local", ""), (start + at + 1, match.end(), "domain", "")]
        elif kind == "name":
            base, gender = match.start("full"), TITLES[match.group("title")]
            parts = [(base + a, base + b) for a, b in name_parts(match.group("full"))]
            found += [(a, b, "name", "last" if n == len(parts) - 1 else gender) for n, (a, b) in enumerate(parts)]
            names.update(text[a:b] for a, b in parts)
            place = parts[-1][1] if parts else base  # words behind the name may be another entity
        else:
            found.append((start, match.end(), "phone" if kind == "intl" else kind, ""))
    return with_mentions(text, found, names) if names else found


def with_mentions(text: str, found: list, names: set[str]) -> list:
    """The entities and, between them, the places where the names are mentioned once more."""
    result, end = [], 0
    for entity in [*found, (len(text), len(text), "", "")]:
        for match in WORD.finditer(text, end, entity[0]):
            if match.group() in names:
                result.append((*match.span(), "name", ""))
        result.append(entity)
        end = entity[1]
    return result[:-1]


class Draw:
    """Numbers from a keyed hash of kind, value and attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.key, self.seed, self.n, self.left = key, f"{kind}\0{value}\0{attempt}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left = hmac.digest(self.key, self.seed + self.n.to_bytes(4, "big"), "sha256")
            self.n += 1
        number, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return number % n

    def like(self, text: str, digits: str = "0123456789", lower: str = "abcdefghijklmnopqrstuvwxyz") -> str:
        """Each digit and letter replaced by one of its sort; letters beyond ASCII count as letters of their case."""
        upper = lower.upper()
        return "".join(
            digits[self.below(len(digits))] if c.isdigit() else upper[self.below(len(upper))] if c.isupper()
            else lower[self.below(len(lower))] if c.isalpha() else c for c in text)


def luhn(digits: str) -> int:
    """0 if the last digit checks."""
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10


def refill(pattern: str, digits: str) -> str:
    each = iter(digits)
    return "".join(next(each) if c.isdigit() else c for c in pattern)


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    draw = Draw(key, kind, value, attempt)
    more = attempt // 4  # after some clashes the format gives way
    if kind == "domain":
        *labels, top = value.split(".")
        first, *others = map(draw.like, labels)
        return ".".join([first + draw.like("a" * more), *others, top])
    if kind == "secret":
        if value.startswith("AKIA"):
            return "AKIA" + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[draw.below(32)] for _ in range(len(value) - 4 + more))
        return "".join("0123456789abcdef"[draw.below(16)] for _ in range(len(value) + more))
    if kind == "card":
        old = re.sub(r"\D", "", value)
        new = old[0] + draw.like(old[1:] + "0" * more)
        if luhn(old) == 0:
            new = new[:-1] + next(d for d in "0123456789" if luhn(new[:-1] + d) == 0)
        return refill(value, new[:len(old)]) + new[len(old):]
    if kind == "iban":
        plain = value.replace(" ", "")
        rest = draw.like(plain[4:] + "0" * more)
        new = iter(plain[:2] + iban_check(plain[:2], rest) + rest)
        return "".join(c if c == " " else next(new) for c in value) + "".join(new)
    if kind == "ip":
        ranges = {1: (1, 9), 2: (10, 99), 3: (100, 255)}
        bounds = [(0, 255) if more else ranges[len(octet)] for octet in value.split(".")]
        bounds += [(0, 255)] * max(0, more - 8)
        return ".".join(str(low + draw.below(high - low + 1)) for low, high in bounds)
    if kind == "phone":
        country = re.match(r"\+\d{1,3}(?=[ .(-])|", value).group()
        rest = value[len(country):]
        return country + "".join("23456789"[draw.below(8)] if c.isdigit() and not rest[:i].strip(" .(-") else draw.like(c)
                                 for i, c in enumerate(rest)) + draw.like("0" * more)
    if kind.startswith("given"):
        gender = kind[-1] if kind[-1] in "mf" else "f" if value.lower()[-1] in "aаяαη" else "m"
        parts, endings = SYLLABLES[script(value)], ENDINGS[script(value), gender]
        name = "".join(parts[draw.below(len(parts))] for _ in range(2 + more)).capitalize() + endings[draw.below(len(endings))]
        return name.upper() if len(value) > 1 and value.isupper() else name
    if kind == "family":
        parts = SYLLABLES[script(value)]
        name = "".join(parts[draw.below(len(parts))] for _ in range(3 + more)).capitalize()
        if script(value) == "cyrillic":  # family names show the gender by their ending
            name += "ва" if value.lower().endswith(("а", "я")) else "в"
        return name.upper() if len(value) > 1 and value.isupper() else name
    return draw.like(value) + draw.like(("0" if kind == "ssn" else "a") * more)


def sliced(batches, at: int):
    """The batches in slices of about half a megabyte of text, which column ``at`` holds."""
    for batch in batches:
        for start, stop in slices(batch.column(at)):
            yield batch.slice(start, stop - start)


def surrogates(values: DataFrame, key: bytes) -> DataFrame:
    """kind, value, surrogate: distinct within a kind and none of them a value of that kind.

    ``values`` has kind, value and, if surrogates of a kind differ in make, style.
    """
    style = F.col("style") if "style" in values.columns else F.col("kind")
    values = stored(values.groupBy("kind", "value").agg(F.min(style).alias("style")), "values")

    def draw(batches):
        for batch in batches:
            _, value, styles, attempts = (c.to_pylist() for c in batch.columns)
            made = [surrogate(key, *row) for row in zip(styles, value, attempts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], ["kind", "value", "style", "attempt", "surrogate"])

    def drawn(rows: DataFrame) -> DataFrame:
        return rows.select("kind", "value", "style", "attempt").mapInArrow(
            releasing(draw), "kind string, value string, style string, attempt int, surrogate string")

    taken = values.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
    settled, table = None, drawn(values.withColumn("attempt", F.lit(0)))
    while True:
        # Of equal surrogates the one drawn at the earliest attempt stays, then that of the least value. What has
        # settled is not written again; redrawn values only look up whether it holds theirs.
        table = stored(table, "surrogates")
        best = table.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "value")).alias("best"))
        marked = table.join(best, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left")
        clash = (F.col("value") != F.col("best.value")) | F.col("real").isNotNull()
        if settled is not None:
            held = settled.select("kind", "surrogate", F.lit(True).alias("held"))
            marked, clash = marked.join(held, ["kind", "surrogate"], "left"), clash | F.col("held").isNotNull()
        marked = stored(marked.select("kind", "value", "style", "attempt", "surrogate", clash.alias("clash")), "surrogates")
        good = marked.where("not clash").select("kind", "value", "surrogate")
        settled = good if settled is None else settled.unionByName(good)
        again = marked.where("clash")
        if again.isEmpty():
            return settled
        table = drawn(again.withColumn("attempt", F.col("attempt") + 1))


def styled(found: DataFrame) -> DataFrame:
    """kind, value, style of all entities found: names become given names of a gender, or family names."""
    seen = found.groupBy("kind", "value").agg(*[F.bool_or(F.col("hint") == h).alias(h) for h in ("m", "f", "n")])
    given = (F.when(F.col("m") & ~F.col("f"), "given_m").when(F.col("f") & ~F.col("m"), "given_f")
             .when(F.col("m") | F.col("n"), "given_n").otherwise("family"))
    return seen.select("kind", "value", F.when(F.col("kind") == "name", given).otherwise(F.col("kind")).alias("style"))


def replace(docs: DataFrame, key: bytes, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced; ``count`` names a column for how many there were."""
    trigger = F.coalesce(F.col(text).rlike(TRIGGER), F.lit(False))
    close = docs.where(trigger)
    digest = F.sha2(F.col(text), 256)

    def find(batches):
        for part in sliced(batches, 1):
            rows = set()
            for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                rows.update((d, k, t[a:b], h) for a, b, k, h in entities(t))
            rows = sorted(rows)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(4)], ["digest", "kind", "value", "hint"])

    found = stored(close.select(digest.alias("digest"), F.col(text).alias("t")).mapInArrow(
        releasing(find), "digest string, kind string, value string, hint string").distinct(), "entities")
    table = surrogates(styled(found), key)
    known = (found.join(table, ["kind", "value"]).groupBy("digest").agg(
        F.collect_set(F.struct("kind", "value", "surrogate")).alias("__pii_known")).withColumnRenamed("digest", "__pii_digest"))
    joined = close.withColumn("__pii_digest", digest).join(stored(known, "known"), "__pii_digest", "left").select(*docs.columns, "__pii_known")
    at = docs.columns.index(text)
    schema = StructType([*docs.schema.fields, StructField("__pii_count", LongType())])
    arrow = to_arrow_schema(schema)

    def put(batches):
        for batch in sliced(batches, at):
            texts, counts = [], []
            for t, known in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                names = {(k["kind"], k["value"]): k["surrogate"] for k in known or ()}
                parts, end, n = [], 0, 0
                for a, b, kind, _ in entities(t) if names else ():
                    parts += [t[end:a], names[kind, t[a:b]]]
                    end, n = b, n + 1
                texts.append("".join([*parts, t[end:]]))
                counts.append(n)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, columns[at].type)
            yield from pa.Table.from_arrays([*columns, pa.array(counts, pa.int64())], names=schema.names).cast(arrow).to_batches()

    done = joined.mapInArrow(releasing(put), schema).unionByName(docs.where(~trigger).withColumn("__pii_count", F.lit(0).cast("long")))
    return done.withColumnRenamed("__pii_count", count) if count else done.drop("__pii_count")
