"""URL filters: rules by host and path, then a weighted vocabulary matched by Aho-Corasick.

Hosts, paths and rules are DataFrame functions. The vocabulary goes over the whole lower-cased
url in one automaton pass per url, in Arrow batches; a form of a term counts only if no letter or digit
touches it. One strict term, or distinct soft terms of a total weight of SOFT_LIMIT, block.

The vocabulary has terms in English, German, French and Spanish. A soft term's weight says how often it
stands in an unwanted url rather than in any other: 1.5 for words that are rare elsewhere (``stripper``), 1 for words of
unwanted trades, 0.5 for words of all trades (``rabatt``). The heaviest alone never blocks: it takes one more, the
light ones four together. Each term has several forms (`forms`): spellings of its letters beyond ASCII, its plural, figures for
the letters of strict terms, and signs between its words. All forms of a term are that term, once.

A null url, or one without ``://``, has an empty host and path, fits no rule; a null url has no terms: it
is allowed. Repeated rows and null ids give one result row each, an empty table none. Columns beyond page_id and url are not
looked at, whatever their names. Rules are few and a parameter, and so is the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextpick.llm.common import UPPER, ascii_lower, once, table

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: The vocabulary, by weight; `_` parts the words of a term, `*` gives it a plural in -s, -es or -en.
STRICT_TERMS = """
casino* porn xxx viagra cialis pills spam betting gambling warez escort* jackpot* malware phishing pornography porno*
camgirl* sexcam* sexchat* levitra xanax tramadol sportsbook* bookmaker* ransomware botnet* keygen* free_spins payday_loan*
get_rich_quick link_farm* kredit_ohne_schufa crédito_rápido
casinospiele sexkontakt* sportwetten wettbüro* glücksspiel* potenzmittel pornofilm* spielautomat*
paris_sportifs machine_à_sous rencontre_coquine jeux_d_argent contrefaçon*
apuesta* tragaperras prostituta* ruleta* dinero_fácil"""
SOFT_TERMS = {
    1.5: """stripper* fetish nude* naked hookup* bingo baccarat blackjack roulette wager* steroid* opioid* replica* clickbait
             doorway_page* weight_loss sugar_daddy
             wette* seitensprung nackt* erotik hochstapler abnehmpille*
             pari* escroquerie* érotique* maigrir_vite crédit_sans_justificatif
             erótico* desnuda* estafa* adelgazar""",
    1: """free cheap win ads track farm bets bet bonus deals promo click loan loans poker slots lottery dating adult crack torrent
           prize winner tracker sale serial* nulled cracked sexy hacked cheats debt* insurance_quote* forex binary_option*
           gratis gewinnspiel* billig lotto partnersuche abofalle raubkopie* schnäppchen sofortkredit*
           gratuit* loterie* gagnant* piratage téléchargement_illégal rencontre*
           barato* lotería* premio* ganador* descarga_ilegal cita*""",
    0.5: """discount* coupon* offer* cash credit* money earn fast limited act_now guarantee* voucher* bargain* rich miracle
             rabatt* gutschein* angebot* kredit* geld verdienen sofort garantiert diät
             remise* offre* argent gagner rapide garanti* régime
             descuento* oferta* dinero ganar rápido garantizado dieta"""}
SOFT_LIMIT = 2
#: Letters beyond ASCII in ASCII, figures for letters, and what may stand between a term's words.
PLAIN = {"ä": "ae", "ö": "oe", "ü": "ue", "à": "a", "á": "a", "ç": "c", "é": "e", "í": "i"}
FIGURES = {"a": "4", "e": "3", "i": "1", "o": "0", "s": "5"}
JOINTS = ["", "-", "_", ".", "+", "%20"]


def forms(term: str, figures: bool = False) -> list[str]:
    """Spellings of a term of the vocabulary in a lower-cased url."""
    plural, words = term.endswith("*"), term.rstrip("*").split("_")
    joined = [joint.join(words) for joint in JOINTS] if len(words) > 1 else words
    every = [w + end for w in joined for end in (("", "s", "es", "en") if plural else ("",))]
    every += ["".join(PLAIN.get(c, c) for c in w) for w in every] + ["".join(
        c if c.isascii() else "".join(f"%{b:02x}" for b in c.encode()) for c in w) for w in every]
    if figures:
        every += [w.replace(letter, figure, most) for w in every for letter, figure in FIGURES.items() for most in (1, -1) if "%" not in w]
    return list(dict.fromkeys(every))


STRICT_FORMS = {term: forms(term, True) for term in STRICT_TERMS.split()}
SOFT_FORMS = {term: forms(term) for own in SOFT_TERMS.values() for term in own.split()}
#: What the automaton looks for: strict forms, the weight of each soft form, and the term of each.
STRICT = list(dict.fromkeys(form for own in STRICT_FORMS.values() for form in own))
SOFT = {form: weight for weight, own in SOFT_TERMS.items() for term in own.split() for form in SOFT_FORMS[term]}
TERMS = {form: term for term, own in [*STRICT_FORMS.items(), *SOFT_FORMS.items()] for form in own}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path of a url; empty where there is no ``://``."""
    there = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return (F.when(there, ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))).otherwise(""),
            F.when(there, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text and verdict; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _automaton(strict: Sequence[str], soft: dict[str, float], terms: dict[str, str] = TERMS):
    made = ahocorasick.Automaton()
    for form, weight in soft.items():
        made.add_word(form, (len(form), terms.get(form, form), weight, False))
    for form in strict:
        made.add_word(form, (len(form), terms.get(form, form), 0.0, True))
    made.make_automaton()
    return made


def term_hits(automaton, url: str) -> tuple[int, float]:
    """Distinct strict terms and the weight of distinct soft terms in a lower-cased url."""
    strict, soft = set(), {}
    for last, (size, term, weight, hard) in automaton.iter(url):
        first = last - size + 1
        before, after = url[first - 1:first] if first else "", url[last + 1:last + 2]
        if (before.isascii() and before.isalnum()) or (after.isascii() and after.isalnum()):
            continue
        if hard:
            strict.add(term)
        else:
            soft[term] = weight
    return len(strict), float(sum(soft.values()))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, strict: Sequence[str] = STRICT,
          soft: dict[str, float] = SOFT, limit: float = SOFT_LIMIT, terms: dict[str, str] = TERMS) -> DataFrame:
    """page_id, host, path, rule, verdict and the term counts of every row of `pages`.

    `strict` are forms, `soft` forms with weights; `terms` says which forms are the same term (the others are their own).
    """
    strict, soft, terms = list(strict), dict(soft), dict(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = once(f"urls-{strict}-{soft}-{terms}", lambda: _automaton(strict, soft, terms))
        lower = str.maketrans(UPPER, UPPER.lower())
        for batch in batches:
            urls = batch.column("url").to_pylist()
            hits = [term_hits(automaton, (u or "").translate(lower)) for u in urls]
            columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "url"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([h[0] for h in hits], pa.int64()), pa.array([h[1] for h in hits], pa.float64())],
                names=["page_id", "host", "path", "rule", "says", "n_strict", "soft_weight"])

    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    counted = rows.withColumns({"rule": rule, "says": says}).mapInArrow(
        count, "page_id bigint, host string, path string, rule string, says string, n_strict bigint, soft_weight double")
    method = F.when((F.col("n_strict") > 0) | (F.col("soft_weight") >= limit), "block").otherwise("allow")
    return counted.select("page_id", "host", "path", "rule", F.coalesce("says", method).alias("verdict"),
                          "n_strict", "soft_weight")


def op4_urls(spark, sf_dir: str) -> DataFrame:
    """Verdict of every page; see `judge`."""
    return judge(table(spark, sf_dir, "pages"))


def _term_sql(every: list[str]) -> str:
    """1 where one of a term's forms stands in a url."""
    any_form = "|".join("".join(c if c.isalnum() or c in "%_-" else f"[{c}]" for c in form) for form in every)
    return f"regexp_matches(low, '(^|[^a-z0-9])({any_form})($|[^a-z0-9])')::BIGINT"


def _oracle() -> str:
    lower = f"translate(%s, '{UPPER}', '{UPPER.lower()}')"
    fits = "\n".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN %s"
                     for h, p, _ in sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r)))
    longest = sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r))
    names = fits % tuple(f"'{h}{p}'" for h, p, _ in longest)
    says = fits % tuple(f"'{v}'" for _, _, v in longest)
    return f"""
WITH cut AS (
  SELECT page_id, coalesce({lower % 'url'}, '') AS low,
         CASE WHEN coalesce(instr(url, '://'), 0) > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, low, {lower % "regexp_extract(rest, '^[^/?#]*')"} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
hits AS (
  SELECT *, {' + '.join(map(_term_sql, STRICT_FORMS.values()))} AS n_strict,
         {' + '.join(f'{SOFT[own[0]]}::DOUBLE * {_term_sql(own)}' for own in SOFT_FORMS.values())} AS soft_weight
  FROM parts)
SELECT page_id, host, path, CASE {names} END AS rule,
       coalesce(CASE {says} END, CASE WHEN n_strict > 0 OR soft_weight >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict, soft_weight
FROM hits"""


ORACLE = _oracle()
