"""Spanish stemmer (published Snowball algorithm) as one Column expression.

Regions are strings: R1, R2 and RV are tails of the word, so "suffix lies in the
region" is "the region ends with the suffix". An alternation anchored at the end
matches at its leftmost start, which is the longest suffix.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressgauge.functions.binding import let

# Letters and suffix lists of the published algorithm.
VOWEL = "aeiouáéíóúü"
REGION_V = (
    rf"^(?:.[^{VOWEL}]+[{VOWEL}]|[{VOWEL}]{{2,}}[^{VOWEL}]|[^{VOWEL}][{VOWEL}].)(.*)$"
)
REGION_1 = rf"^[^{VOWEL}]*[{VOWEL}]+[^{VOWEL}](.*)$"
PRONOUN = "(?:selas|selos|sela|selo|las|les|los|nos|me|se|la|le|lo)"
VERB_BEFORE_PRONOUN = "(?:iéndo|ándo|ár|ér|ír|iendo|ando|ar|er|ir)"
ADVERB_EXTRA = "(?:ativ|iv|os|ic|ad)amente$"
DELETED = (
    "(?:anzas?|ic[ao]s?|ismos?|ables?|ibles?|istas?|os[ao]s?|[ai]mientos?"
    "|(?:ic)?(?:adoras?|ador|adores|ación|acion|aciones|antes?|ancias?)"
    "|(?:ante|able|ible)?mente|(?:abil|ic|iv)?idad(?:es)?|(?:at)?iv[ao]s?)$"
)
TO_LOG = "logías?$"
TO_U = "uci(?:ón|on|ones)$"
TO_ENTE = "encias?$"
Y_VERB = "(?:yeron|yendo|yamos|yais|yan|yen|yas|yes|ya|ye|yo|yó)$"
E_VERB = "(?:emos|éis|en|es)"
VERB = (
    "(?:arían|arías|arán|arás|aríais|aría|aréis|aríamos|aremos|ará|aré"
    "|erían|erías|erán|erás|eríais|ería|eréis|eríamos|eremos|erá|eré"
    "|irían|irías|irán|irás|iríais|iría|iréis|iríamos|iremos|irá|iré"
    "|aba|ada|ida|ía|ara|iera|ad|ed|id|ase|iese|aste|iste|an|aban|ían|aran|ieran"
    "|asen|iesen|aron|ieron|ado|ido|ando|iendo|ió|ar|er|ir|as|abas|adas|idas|ías"
    "|aras|ieras|ases|ieses|ís|áis|abais|íais|arais|ierais|aseis|ieseis|asteis"
    "|isteis|ados|idos|amos|ábamos|íamos|imos|áramos|iéramos|iésemos|ásemos"
    "|emos|éis|en|es)$"
)
RESIDUE = "(?:os|a|o|á|í|ó|e|é)$"


def _tail(word: Column, pattern: str) -> Column:
    return F.regexp_extract(word, pattern, 1)


def _cut(word: Column, suffix: Column) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - F.length(suffix))


def _drop_pronoun(w: Column) -> Column:
    bare = F.translate(F.regexp_replace(w, f"{PRONOUN}$", ""), "áéí", "aei")

    def in_region(rv: Column) -> Column:
        attached = rv.rlike(f"{VERB_BEFORE_PRONOUN}{PRONOUN}$") | (
            rv.rlike(f"yendo{PRONOUN}$") & w.rlike(f"uyendo{PRONOUN}$")
        )
        return F.when(attached, bare).otherwise(w)

    return F.when(w.rlike(f"r{PRONOUN}$|ndo{PRONOUN}$"), let(_tail(w, REGION_V), in_region)).otherwise(w)


def _drop_standard(w: Column) -> Column:
    def in_regions(r1: Column, r2: Column) -> Column:
        adverb = F.when(
            r2.rlike(ADVERB_EXTRA), _cut(w, F.regexp_extract(r2, ADVERB_EXTRA, 0))
        ).when(r1.endswith("amente"), _cut(w, F.lit("amente"))).otherwise(w)
        other = (
            F.when(r2.rlike(TO_LOG), F.regexp_replace(w, TO_LOG, "log"))
            .when(r2.rlike(TO_U), F.regexp_replace(w, TO_U, "u"))
            .when(r2.rlike(TO_ENTE), F.regexp_replace(w, TO_ENTE, "ente"))
            .otherwise(_cut(w, F.regexp_extract(r2, DELETED, 0)))
        )
        return F.when(w.endswith("amente"), adverb).otherwise(other)

    return let(
        _tail(w, REGION_1), lambda r1: let(_tail(r1, REGION_1), lambda r2: in_regions(r1, r2))
    )


def _drop_verb(w: Column) -> Column:
    def by_verb(v: Column) -> Column:
        bare = _cut(w, v)
        return F.when(
            v.rlike(f"^{E_VERB}$") & bare.endswith("gu"), _cut(bare, F.lit("u"))
        ).otherwise(bare)

    def in_region(rv: Column) -> Column:
        y_form = F.regexp_extract(rv, Y_VERB, 0)
        after_u = (y_form != "") & w.endswith(F.concat(F.lit("u"), y_form))
        return F.when(after_u, _cut(w, y_form)).otherwise(
            let(F.regexp_extract(rv, VERB, 0), by_verb)
        )

    return let(_tail(w, REGION_V), in_region)


def _drop_residue(w: Column) -> Column:
    def in_region(rv: Column) -> Column:
        silent_u = rv.rlike("u[eé]$") & w.rlike("gu[eé]$")
        return F.when(silent_u, _cut(w, F.lit("ue"))).otherwise(
            _cut(w, F.regexp_extract(rv, RESIDUE, 0))
        )

    return let(_tail(w, REGION_V), in_region)


def spanish_stem(word: Column) -> Column:
    """Stem of one lower-case word; also valid inside ``transform`` on a word array."""
    return let(
        _drop_pronoun(word),
        lambda a: let(
            _drop_standard(a),
            lambda b: let(
                F.when(b != a, b).otherwise(_drop_verb(a)),
                lambda c: F.translate(_drop_residue(c), "áéíóú", "aeiou"),
            ),
        ),
    )
