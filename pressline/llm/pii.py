"""Personal data by candidate gradient boosting, in Catalyst expressions only.

High-recall generators (regular expressions) propose overlapping spans. Each
candidate is reduced to a few binned features of its format and its context.
Boosted trees learn from labelled spans: personal data in many written forms, and
what looks like them but is none, planted into the text around random places of a
bounded sample of documents. Candidates over a planted span have its label, whatever
a validator says. The trees are fitted to the counts per feature combination, a table
bounded by the product of the bins. Calibrated thresholds, one for each kind, select the
spans that are added to the validated ones. Scoring is one CASE expression.

Offsets come from the lengths of the matches and of the gaps between them,
summed by a window over the spans of one document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressline.llm.words import sampled_texts
from pressline.session import discard, stored

KINDS = ("email", "ip", "card", "phone")
# All patterns are linear in the text: a match starts where its run starts or
# where the last match ended, and repeats are possessive or of bounded length.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:\x20?(?:@|[(\[{](?:at|@)[)\]}])\x20?|\x20at\x20)"
_DOT = r"(?:\.|\x20\.\x20|\x20?[(\[{](?:dot|\.)[)\]}]\x20?|\x20dot\x20)"
#: Looser forms of each kind, all scored by the trees.
LOOSE = {
    "email": rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+(?:\x20dot\x20[A-Za-z0-9_%+-]{{1,64}}+){{0,3}}+{_AT}[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{1,63}}+){{1,8}}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\{\.\}|\.)[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,18}+(?![0-9])",
    "phone": r"(?<![0-9+.,])(?:\(\+?[0-9]{2,5}+\)\x20?|\+?[0-9]{1,5}+[\x20./-]{1,2}+(?:\(0\)\x20?)?)[0-9]{2,8}+(?:[\x20./-]{1,2}+[0-9]{2,8}+){0,4}+(?![0-9]|[.,][0-9])",
}
#: Written forms of personal data. # is a digit, $ one from 2 to 9, ? a letter, % a number up to 255.
PLANTED = {
    "email": [
        "????.##@?????.com", "???@????????.org", "?????? (at) ???????.com", "????.????? [at] ?????.net", "?????##(at)?????? (dot) org", "????? @ ???????.com", "???????[at]?????[dot]co", "??????_????(at)????.edu",
        "???? dot ????? at ?????? dot com", "?????{at}??????{dot}net", "????? AT ?????? DOT de", "????.????? at ?????.org", "???? at ??????? dot fr", "?????(@)????????.uk", "??? [at] ???? [dot] ????? [dot] org", "?????? at ???? dot co dot uk",
    ],
    "ip": ["%.%.%.%", "%[.]%[.]%[.]%", "%(.)%(.)%(.)%", "1##.1##.##.2#", "1##.2#.1##.##", "#[.]#[.]#[.]#", "1#[.]#[.]#[.]$", "%[.]%.%.%", "%.%.%[.]%", "#(.)##(.)#(.)1##", "%{.}%{.}%{.}%", "$#.$#.##.#"],
    "card": ["4### #### #### ####", "5###-####-####-####", "4###.####.####.####", "4###############", "3###.####.####.####", "#### #### #### ####", "5###############", "####-####-####-####", "3### ###### #####", "6### #### #### ####"],
    "phone": [
        "($##) $##-####", "$##-$##-####", "$##.$##.####", "$## $## ####", "(0##) ###-####", "0###-###-####", "#### ### ####", "($##)$##-####", "0## #### ####", "0#### ### ###", "0#### ######", "0###/#######", "00## ## ######", "00## # ## ## ## ##",
        "0# ## ## ## ##", "(0##) ### ## ##", "+## (0)## ### ####", "0##-#######", "1-$##-$##-####", "($##) $##.####", "0### ######", "+## ### ### ###", "0##.###.####", "00##-###-#######",
    ],
}
#: What looks like the above and is none. UNCLEAR forms are none only behind a word of AGAINST or before one of UNITS.
DECOYS = [
    "??????? (at) noon", "@???????", "(at) ????????", "?????? (at) the ????", "@ ??? ????", "?????? @ ####", "????? (at) noon (dot) ?", "?????? at ## dot ##", "???? at ?????. ??? ?????", "????? at ####.##", "??? dot ??? at ??????", "???? @ ##.##", "?????? at ?????.#",
    "20##-##-## ###", "##/##/20##", "1,###,###.##", "#### - ####", "##:##:##", "#.###.###,##", "####-####", "978-#-####-####-#", "978##########", "1## 2## 3###", "#00-#00-#000", "1##.2##.3###", "1## #0# ####", "101 ### ####", "##.##.20##", "20##/20##", "1### 1###", "## ## ##",
    "############", "#.#.##", "19## - 19##", "#00 #00", "##-##", "3##.4##.5##.6##", "9##[.]9##[.]#[.]#", "0.### ###", "##.##.##.####", "0.#.#.#",
]
UNCLEAR = [
    "#.#.##.#", "##.#.#.##", "#.##.#.#", "#.#.#.#", "################", "############", "##################", "####.####.####.####.###", "###-###-####-###", "### ### #### ##", "##-###-####-##", "###.###.####.##", "#### #### #### ####", "##############",
    "### ### ####", "###-###-####", "$##-$##-####", "###.###.####", "####-###-###", "## ### ####", "0###-####", "### ####", "$## $## ####", "(###) ###-####", "0## ### ####", "[#.#.##.#]", "### #### ####",
]
#: Words of which one before a candidate speaks for its kind, and those before or behind it that speak against any.
CUES = {
    "email": "mail e-mail email contact write send reach inbox reply",
    "ip": "ip host server address ping node gateway client router",
    "card": "card visa mastercard amex debit credit charged paid account",
    "phone": "call phone tel telephone fax mobile cell ring dial sms whatsapp reach",
}
AGAINST = (
    "version v ver section chapter release build order isbn issn invoice tracking serial id item part number no nr line lines sum price prices total row rows page pages code ref reference model sku lot batch ticket case article figure table score points size range volume edition"
    " book catalogue weight length count years between of about over under"
)
UNITS = "total points units rows items pages km kg m cm mm votes euros dollars pounds times pieces percent copies words lines entries eur usd gbp meters miles"
#: Documents whose text surrounds the planted spans.
SAMPLE_DOCS = 150
#: Where none of these occurs, no generator can match.
TRIGGER = r"[0-9@]|(?i)[(\[{]at[)\]}]|\x20at\x20"
_NEAR = r"(?:\x20(?:is|at|me|us|on|to|no|nr|number|address))?[^A-Za-z0-9]{0,3}$"
_WORD = r"(?i)(?<![A-Za-z])(?:%s)"
CUE = {kind: _WORD % own.replace(" ", "|") + _NEAR for kind, own in CUES.items()}
BEFORE_AGAINST = _WORD % AGAINST.replace(" ", "|") + r"[^A-Za-z0-9]{0,3}$|[$€£#§]\x20?$"
AFTER_AGAINST = r"(?i)^(?:\x20?(?:%s)(?![A-Za-z])|\x20?[%%€$£])" % UNITS.replace(" ", "|")
KNOWN_TLD = "com|org|net|edu|gov|info|biz|io|co|uk|de|fr|es|it|nl|ch|at|ca|us|eu"
#: Characters of context kept on either side of a candidate.
CONTEXT = 24
ROUNDS, RATE, MIN_PRECISION = 40, 0.4, 0.9

#: Feature -> number of bins. Their product bounds the table that the trees are fitted to.
BINS = {
    "digits": 10, "letters": 3, "groups": 6, "space": 2, "dash": 2, "dot": 2, "slash": 2, "plus": 2, "paren": 2, "at": 4, "spelled": 4, "tld": 4, "octets": 2, "bracket": 2, "shape": 7, "first": 4,
    "cue": 2, "against": 2, "unit": 2, "before": 3, "after": 3, "even": 2,
}


def _count(text: Column, keep: str) -> Column:
    return F.length(F.regexp_replace(text, keep, ""))


def features(hit: Column, before: Column, after: Column, kind: Column | None = None) -> dict[str, Column]:
    digits, letters = _count(hit, "[^0-9]"), _count(hit, "[^A-Za-z]")
    edge = lambda c: F.when(c == "", 0).when(c.rlike("[A-Za-z0-9]"), 2).when(c.rlike(r"\s"), 0).otherwise(1)
    has = lambda s: F.contains(hit, F.lit(s)).cast("int")
    last = F.regexp_extract(hit, r"([A-Za-z0-9-]*)$", 1)
    own = F.lit(False)
    for name, pattern in CUE.items():
        own = F.when(F.lit(True) if kind is None else kind == name, own | before.rlike(pattern)).otherwise(own)
    cue = F.coalesce(own, F.lit(False))
    binned = F.lit(9)
    for i, top in reversed(list(enumerate((0, 4, 6, 8, 9, 10, 12, 15, 19)))):
        binned = F.when(digits <= top, i).otherwise(binned)
    return {
        "digits": binned,
        "letters": F.when(letters == 0, 0).when(letters <= 6, 1).otherwise(2),
        "groups": F.least(F.lit(5), _count(F.regexp_replace(hit, "[0-9]++", "#"), "[^#]")),
        "space": has(" "),
        "dash": has("-"),
        "dot": has("."),
        "slash": has("/"),
        "plus": has("+"),
        "paren": has("("),
        "at": F.when(hit.rlike(r"[(\[{](?i:at|@)[)\]}]"), 2).when(F.contains(hit, F.lit("@")), 1).when(hit.rlike(r"(?i)\x20at\x20"), 3).otherwise(0),
        "spelled": F.when(hit.rlike(r"[(\[{](?i:dot|\.)[)\]}]"), 2).when(hit.rlike(r"(?i)\x20dot\x20"), 3).when(hit.rlike(r"[A-Za-z0-9]\.[A-Za-z0-9]"), 1).otherwise(0),
        "tld": F.when(~last.rlike(r"^[A-Za-z]{2,}$"), 0).when(last.rlike(rf"^(?i:{KNOWN_TLD})$"), 3).when(F.length(last) == 2, 2).otherwise(1),
        "octets": hit.rlike(rf"^{OCTET}(?:[^0-9]+{OCTET}){{3}}$").cast("int"),
        "bracket": hit.rlike(r"[0-9][(\[{]\.[)\]}][0-9]").cast("int"),
        # 3-3-4 as North America writes it, or nearly; trunk, international and plus prefixes; the rest
        "shape": F.when(hit.rlike(r"^\+"), 6).when(hit.rlike(r"^00[1-9]"), 5).when(hit.rlike(r"^\(?0[1-9]"), 4).when(hit.rlike(r"^(?:1[\x20.-])?\(?[2-9][0-9]{2}\)?[\x20.-]{0,2}[2-9][0-9]{2}[\x20.-][0-9]{4}$"), 3).when(hit.rlike(r"^\(?[0-9]{3}\)?[\x20.-]{0,2}[0-9]{3}[\x20.-][0-9]{4}$"), 2).when(hit.rlike(r"^(?:19|20)[0-9]{2}"), 1).otherwise(0),
        "first": F.when(hit.rlike("^[3-6]"), 1).when(hit.rlike("^[01]"), 2).when(hit.rlike("^97[89]"), 3).otherwise(0),
        "cue": cue.cast("int"),
        "against": before.rlike(BEFORE_AGAINST).cast("int"),
        "unit": after.rlike(AFTER_AGAINST).cast("int"),
        "before": edge(F.right(before, F.lit(1))),
        "after": edge(F.left(after, F.lit(1))),
        "even": hit.rlike(r"^[0-9]{4}([ .-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$").cast("int"),
    }


def luhn(hit: Column) -> Column:
    digits = F.reverse(F.regexp_replace(hit, "[^0-9]", ""))
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def valid(kind: Column, hit: Column) -> Column:
    """The base rules: what a match of a BASE pattern must also meet."""
    digits = _count(hit, "[^0-9]")
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", hit.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
        .when(kind == "card", digits.between(13, 19) & F.when(digits.between(13, 19), luhn(hit)))
        .otherwise(digits.between(9, 15))
    )


def _found(text: Column, generator: str, kind: str, pattern: str) -> Column:
    """Array of the matches of one generator, with the gap before each and its surroundings."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    one = lambda hit, i: F.struct(
        F.lit(generator).alias("generator"),
        F.lit(kind).alias("kind"),
        i.alias("n"),
        F.length(F.get(gaps, i)).alias("gap"),
        F.length(hit).alias("size"),
        hit.alias("hit"),
        F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
        F.left(F.get(gaps, i + 1), F.lit(8)).alias("after"),
    )
    return F.transform(hits, one)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows has row_id and id of every document, spans all candidates with offsets.

    Spans carry generator, kind, start, end (code points, end exclusive), base
    (a validated match of a BASE pattern) and the features.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    generators = [("base", k, p) for k, p in BASE.items()] + [("loose", k, p) for k, p in LOOSE.items()]
    found = F.flatten(F.array(*(_found(F.col("data"), *g) for g in generators)))
    base = docs.select(F.col(id_col).alias("id"), text.alias("data"))
    base = base.withColumn("found", F.when(F.col("data").rlike(TRIGGER), found))
    rows = stored(base.select(F.monotonically_increasing_id().alias("row_id"), "id", "found"), "found")
    spans = rows.where(F.size("found") > 0).select("row_id", F.explode("found").alias("f")).select("row_id", "f.*")
    line = Window.partitionBy("row_id", "generator", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = spans.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(line)).withColumn("start", F.col("end") - F.col("size"))
    # rules and features see the whole hit: dots, blanks and leading zeros can make a valid one long
    spans = spans.withColumn("ok", F.coalesce(valid(F.col("kind"), F.col("hit")), F.lit(False)))
    spans = spans.withColumn("base", (F.col("generator") == "base") & F.col("ok"))
    spans = spans.withColumns(features(F.col("hit"), F.col("before"), F.col("after"), F.col("kind")))
    spans = stored(spans.select("row_id", "generator", "kind", "start", "end", "base", *BINS), "spans")
    ids = stored(rows.select("row_id", "id"), "rows")
    discard(rows)
    return ids, spans


def planted(docs: DataFrame, text_col: str = "text", most: int = SAMPLE_DOCS) -> DataFrame:
    """Labelled rows: id (place, seed, kind, form, start, end) and text with one planted span.

    Every form stands once in each of `most` distinct texts at most, those of smallest hash, and in
    eight texts of its own; kind is empty where the span is no personal data. Half of the personal
    spans follow a cue of their kind. Of the decoys a third stands bare and the others behind a word of AGAINST or
    before one of UNITS, as those of UNCLEAR always do."""
    sample = sampled_texts(docs, most, 11, text_col)
    at = F.pmod("h", F.greatest(F.length("t") - 2 * CONTEXT, F.lit(1))).cast("int")
    around = sample.select("h", F.substring("t", at + 1, F.lit(CONTEXT)).alias("left"), F.substring("t", at + CONTEXT + 1, F.lit(CONTEXT)).alias("right"))
    around = around.unionByName(docs.sparkSession.range(8).select(F.xxhash64("id").alias("h"), F.lit("").alias("left"), F.lit("").alias("right")))
    listed = [(kind, i, form, cues) for kind, forms in PLANTED.items() for i, (form, cues) in enumerate((f, CUES[kind]) for f in forms)]
    listed += [("", i, form, "bare") for i, form in enumerate(DECOYS)] + [("", len(DECOYS) + i, form, "marked") for i, form in enumerate(UNCLEAR)]
    forms = F.array(*(F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("form"), F.lit(form).alias("format"), F.lit(cues).alias("cues")) for kind, i, form, cues in listed))
    rows = around.select("*", F.explode(forms).alias("f")).select("h", "left", "right", "f.*")
    seed = F.xxhash64("h", "kind", "form")
    rows = rows.withColumn("seed", seed).withColumn("digits", F.translate(F.sha2(F.col("seed").cast("string").cast("binary"), 512), "abcdef", "012345"))
    draw = lambda words, salt: F.get(F.split(words, " "), F.pmod(F.xxhash64("seed", F.lit(salt)), F.size(F.split(words, " "))).cast("int"))
    way = F.pmod(F.xxhash64("seed", F.lit(1)), F.lit(6))
    joint = F.get(F.array(*map(F.lit, [" ", ": ", " is ", " number ", " - ", " "])), F.pmod(F.xxhash64("seed", F.lit(2)), F.lit(6)).cast("int"))
    against = F.concat(draw(F.lit(AGAINST), 3), F.get(F.array(*map(F.lit, [" ", ": ", ". "])), F.pmod(F.xxhash64("seed", F.lit(4)), F.lit(3)).cast("int")))
    decoy = F.col("kind") == ""
    lead = F.when(~decoy & (way < 3), F.concat(draw(F.col("cues"), 5), joint)).when(decoy & (way > 3), against).when(decoy & (F.col("cues") == "marked") & (way > 1), against).otherwise("")
    unit = F.when(decoy & (way <= 3) & ((way > 1) | (F.col("cues") == "marked")) & (lead == ""), F.concat(F.lit(" "), draw(F.lit(UNITS), 6))).otherwise("")
    drawn = lambda c, i: (
        F.when(c == "#", F.substring("digits", i + 1, F.lit(1))).when(c == "$", F.translate(F.substring("digits", i + 1, F.lit(1)), "01", "73")).when(c == "?", F.translate(F.substring("digits", i + 1, F.lit(1)), "0123456789", "aeinorstlm")).when(c == "%", (F.substring("digits", 2 * i + 1, F.lit(3)).cast("int") % 256).cast("string")).otherwise(c)
    )
    span = F.array_join(F.transform(F.split("format", ""), drawn), "")
    gap = lambda c: F.when(c == "", "").otherwise(" ")
    rows = rows.withColumns({"span": span, "head": F.concat("left", gap(F.col("left")), lead), "unit": unit})
    rows = rows.withColumns({"start": F.length("head"), "end": F.length("head") + F.length("span")})
    return rows.select(F.struct("h", "seed", "kind", "form", "start", "end").alias("id"), F.concat("head", "span", "unit", gap(F.col("right")), "right").alias("text"))


def labelled(docs: DataFrame, text_col: str = "text", fold: int | None = None, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): the planted rows with kind, and their loose candidates that overlap the planted span, with label y.

    A quarter of the rows is `held` back for calibration. With a fold, all rows of every fifth form are
    a `test` that neither fits nor calibrates: forms that the trees have never seen."""
    rows, spans = candidates(planted(docs, text_col), "id", "text")
    test = F.lit(False) if fold is None else F.pmod("id.form", F.lit(folds)) == fold
    rows = rows.select("row_id", F.col("id.kind").alias("truth"), F.col("id.start").alias("from"), F.col("id.end").alias("to"), (F.pmod("id.seed", F.lit(8)) < 2).alias("held"), test.alias("test"))
    over = spans.where("generator = 'loose'").join(rows, "row_id").where("start < to and end > from")
    return rows, over.withColumn("y", (F.col("kind") == F.col("truth")).cast("int"))


class Boosted:
    """Depth-two regression trees on binned features, logistic loss, fitted to weighted cells."""

    def __init__(self, cells: list[tuple[tuple[int, ...], float, float]]):
        """cells: (feature values, positives, all)"""
        self.trees: list[tuple] = []
        total, positive = sum(c[2] for c in cells), sum(c[1] for c in cells)
        self.prior = math.log((positive + 1) / (total - positive + 1))
        scores = [self.prior] * len(cells)
        for _ in range(ROUNDS if 0 < positive < total else 0):
            prob = [1 / (1 + math.exp(-s)) for s in scores]
            grad = [c[1] - c[2] * p for c, p in zip(cells, prob, strict=True)]
            hess = [c[2] * p * (1 - p) for c, p in zip(cells, prob, strict=True)]
            every = list(range(len(cells)))
            root = self._split(cells, grad, hess, every)
            if root is None:
                break
            leaves = []
            for side in ([i for i in every if cells[i][0][root[0]] <= root[1]], [i for i in every if cells[i][0][root[0]] > root[1]]):
                cut = self._split(cells, grad, hess, side)
                low = [i for i in side if cut is None or cells[i][0][cut[0]] <= cut[1]]
                high = [i for i in side if cut is not None and cells[i][0][cut[0]] > cut[1]]
                values = [RATE * sum(grad[i] for i in part) / (sum(hess[i] for i in part) + 1) for part in (low, high)]
                for part, value in zip((low, high), values, strict=True):
                    for i in part:
                        scores[i] += value
                leaves.append((cut, values[0], values[1]))
            self.trees.append((root, *leaves))

    @staticmethod
    def _split(cells, grad, hess, rows):
        """(feature, value) of the best cut `<= value`, or None."""
        best, place = 1e-6, None
        g_all, h_all = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        for f in range(len(BINS)):
            g, h = {}, {}
            for i in rows:
                v = cells[i][0][f]
                g[v], h[v] = g.get(v, 0) + grad[i], h.get(v, 0) + hess[i]
            gl = hl = 0.0
            for v in sorted(g)[:-1]:
                gl, hl = gl + g[v], hl + h[v]
                gain = gl * gl / (hl + 1) + (g_all - gl) ** 2 / (h_all - hl + 1) - g_all * g_all / (h_all + 1)
                if gain > best:
                    best, place = gain, (f, v)
        return place

    def score(self, values) -> float:
        s = self.prior
        for (f, v), *sides in self.trees:
            cut, low, high = sides[values[f] > v]
            s += low if cut is None or values[cut[0]] <= cut[1] else high
        return 1 / (1 + math.exp(-s))

    def column(self) -> Column:
        names = list(BINS)
        total = F.lit(float(self.prior))
        for (f, v), *sides in self.trees:
            leaf = [F.lit(low) if cut is None else F.when(F.col(names[cut[0]]) <= cut[1], F.lit(low)).otherwise(F.lit(high)) for cut, low, high in sides]
            total = total + F.when(F.col(names[f]) <= v, leaf[0]).otherwise(leaf[1])
        return 1 / (1 + F.exp(-total))


def fit(spans: DataFrame) -> dict[str, tuple[Boosted, float]]:
    """kind -> (trees, threshold). The threshold is the least score whose precision on the
    labelled spans held back for calibration is MIN_PRECISION; 0.5 at least."""
    held = F.col("held")
    cells = spans.where(~F.col("test")).groupBy("kind", *BINS).agg(
        F.sum(F.when(~held, F.col("y")).otherwise(0)).alias("pos"), F.sum(F.when(~held, 1).otherwise(0)).alias("all"), F.sum(F.when(held, F.col("y")).otherwise(0)).alias("cal_pos"), F.sum(F.when(held, 1).otherwise(0)).alias("cal_all")
    )
    rows = cells.collect()
    out = {}
    for kind in KINDS:
        own = sorted((tuple(int(r[f]) for f in BINS), r["pos"], r["all"], r["cal_pos"], r["cal_all"]) for r in rows if r["kind"] == kind)
        model = Boosted([(c[0], float(c[1]), float(c[2])) for c in own if c[2]])
        ranked = sorted(((model.score(c[0]), c[3], c[4]) for c in own), reverse=True)
        threshold, pos, n = 1.0, 0, 0
        for i, (s, p, a) in enumerate(ranked):
            pos, n = pos + p, n + a
            if s >= 0.5 and (i + 1 == len(ranked) or ranked[i + 1][0] < s) and pos >= MIN_PRECISION * n:
                threshold = s
        out[kind] = (model, threshold)
    return out


def chosen(models: dict[str, tuple[Boosted, float]]) -> Column:
    """Whether the trees of its kind select a loose candidate."""
    out = F.lit(False)
    for kind, (model, threshold) in models.items():
        out = F.when((F.col("kind") == kind) & (F.col("generator") == "loose"), model.column() >= F.lit(threshold - 1e-9)).otherwise(out)
    return out


def measured(rows: DataFrame, spans: DataFrame, models) -> dict[str, tuple[float, float]]:
    """kind -> (precision, recall) on the planted test rows: of the selected candidates, those of the
    planted kind; of the planted spans of a kind, found by a generator or not, those with a selected candidate."""
    hit = spans.where("test").where(chosen(models))
    right = {r.kind: r for r in hit.groupBy("kind").agg(F.sum("y").alias("good"), F.count(F.lit(1)).alias("all"), F.count_distinct(F.when(F.col("y") == 1, F.col("row_id"))).alias("rows")).collect()}
    there = {r.truth: r["count"] for r in rows.where("test").groupBy("truth").count().collect()}
    return {k: (right[k]["good"] / right[k]["all"] if k in right else 1.0, (right[k]["rows"] if k in right else 0) / there[k]) for k in KINDS}


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every row, and the spans to redact: row_id, kind, start, end, base."""
    rows, spans = candidates(docs, id_col, text_col)
    models = fit(labelled(docs, text_col)[1])
    picked = spans.where(F.col("base") | chosen(models)).groupBy("row_id", "kind", "start", "end").agg(F.max("base").alias("base"))
    # an added span that overlaps a validated one says nothing new
    line = Window.partitionBy("row_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy("row_id").orderBy(F.desc("start"), F.desc("end")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = picked.withColumn("left", F.max(F.when(F.col("base"), F.col("end"))).over(line)).withColumn("right", F.min(F.when(F.col("base"), F.col("start"))).over(back))
    free = (F.coalesce(F.col("left"), F.lit(0)) <= F.col("start")) & (F.col("right").isNull() | (F.col("right") >= F.col("end")))
    return rows, picked.where(F.col("base") | free).drop("left", "right")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    A null or empty text has no spans and the digest of the empty string; an empty table
    gives no rows; repeated rows and null ids are reported each. Texts are searched whole,
    and hits judged whole, however long. Added spans may overlap each other, never a
    validated one; equal spans of one kind count once. Only the two named columns are read,
    so other columns may have any name.
    """
    rows, spans = find_pii(docs, id_col, text_col)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    said = F.concat_ws(":", "kind", "start", "end")
    entry = F.struct(rank.alias("rank"), F.col("start"), F.col("end"), said.alias("said"))
    text = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: x["said"]), ",")
    per = spans.groupBy(F.col("row_id").alias("of_row")).agg(
        *(F.sum(((F.col("kind") == k) & F.col("base")).cast("long")).alias(f"n_{k}") for k in KINDS),
        F.sum((~F.col("base")).cast("long")).alias("n_added"),
        text(F.collect_list(F.when(F.col("base"), entry))).alias("base_said"),
        text(F.collect_list(entry)).alias("spans"),
    )
    out = rows.join(per, rows["row_id"] == per["of_row"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(F.col("id").alias("doc_id"), *(zero(f"n_{k}") for k in KINDS), F.sha2(F.coalesce("base_said", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), zero("n_added"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every span in text_col replaced by [KIND]; other columns as they are.

    Overlapping spans become one, named after the first; of equal starts the shorter names it.
    Null texts stay null, an empty table stays empty, and columns may have any name. The
    spans come back to their texts by id and text hash, so whole rows are shuffled once.
    """
    key = F.struct(F.col(id_col), F.xxhash64(F.col(text_col)))
    rows, spans = find_pii(docs.select(key.alias("key"), F.col(text_col).alias("data")), "key", "data")
    one = F.struct("start", "end", F.upper("kind").alias("kind"))
    spans = spans.join(rows, "row_id").groupBy(F.col("id").alias("key")).agg(F.array_sort(F.collect_set(one)).alias("spans"))
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("data"), key.alias("key"))
    joined = whole.join(spans, "key", "left")
    text = F.col("data")
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        fresh = F.struct(F.concat(a["out"], gap, F.lit("["), s["kind"], F.lit("]")).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] >= a["at"], fresh).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at")))

    clean = F.aggregate("spans", begin, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    text = F.when(F.col("spans").isNull(), text).otherwise(clean)
    return joined.select(*(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
