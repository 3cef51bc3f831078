"""Porter stemming (extended variant) written as DuckDB SQL, for the oracle of the stem and bag-of-words keys.

Each step is one CTE over ``(token, w)``. ``cv`` is the consonant/vowel pattern of the current
word (``y`` alternates along a run of ``y`` from the run's start); the pattern of a prefix is the
prefix of the pattern, and the measure of a stem is the number of ``vc`` transitions in its
pattern. The rules are written out here once more, so a wrong rule on either side shows.
"""

from __future__ import annotations

# Fixed values of the published algorithm and its extensions.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent",
    "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = "ement ance ence able ible ment ant ent ion ism ate iti ous ive ize al er ic ou".split()
IRREGULAR = {
    "sky": "sky skies", "die": "dying", "lie": "lying", "tie": "tying", "news": "news", "inning": "inning innings",
    "outing": "outing outings", "canning": "canning cannings", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

VOWELS = "('a', 'e', 'i', 'o', 'u')"


def _cv(w: str) -> str:
    pre = f"substr({w}, 1, i)"
    start = f"(i - (length({pre}) - length(rtrim({pre}, 'y'))) + 1)"
    start_class = f"(case when {start} = 1 then 'c' when substr({w}, {start} - 1, 1) in {VOWELS} then 'c' else 'v' end)"
    y_class = f"(case when ((i - {start}) % 2 = 0) = ({start_class} = 'c') then 'c' else 'v' end)"
    return (
        f"array_to_string(list_transform(range(1, length({w}) + 1), lambda i: "
        f"case when substr({w}, i, 1) in {VOWELS} then 'v' when substr({w}, i, 1) <> 'y' then 'c' else {y_class} end), '')"
    )


def _m(n: str) -> str:
    """Measure of the first ``n`` letters (``cv`` column of the current word)."""
    p = f"left(cv, {n})"
    return f"(length({p}) - length(replace({p}, 'vc', 'v')))"


def _has_vowel(n: str) -> str:
    return f"(position('v' in left(cv, {n})) > 0)"


def _cvc(n: str, w: str = "w") -> str:
    """Stem of ``n`` letters ends consonant-vowel-consonant, last not w, x or y."""
    return f"(({n} = 2 and left(cv, 2) = 'vc') or {n} >= 3 and substr(cv, {n} - 2, 3) = 'cvc' and substr({w}, {n}, 1) not in ('w', 'x', 'y'))"


def _double(n: str, w: str = "w") -> str:
    return f"({n} >= 2 and substr({w}, {n}, 1) = substr({w}, {n} - 1, 1) and substr(cv, {n}, 1) = 'c')"


def _step(name: str, src: str, expr: str) -> str:
    return f"""{name}_cv as (select token, w, {_cv('w')} as cv from {src}),
{name} as (select token, case when length(token) <= 2 then w else {expr} end as w from {name}_cv)"""


def porter_sql(tokens_cte: str) -> str:
    """CTEs ending in ``stems(token, stem)`` for the distinct tokens of ``tokens_cte(token)``."""
    L = "length(w)"
    s1a = (
        "case when w like '%sses' then left(w, length(w) - 2) when w like '%ies' then left(w, length(w) - (case length(w) when 4 then 1 else 2 end)) "
        "when w like '%ss' then w when w like '%s' then left(w, length(w) - 1) else w end"
    )
    # step 1b part 1: mark whether the ed/ing rule fired
    s1b = (
        f"case when w like '%ied' then left(w, {L} - (case {L} when 4 then 1 else 2 end)) when w like '%eed' then (case when {_m(f'{L} - 3')} > 0 then left(w, {L} - 1) else w end) "
        f"when w like '%ed' and {_has_vowel(f'{L} - 2')} then left(w, {L} - 2) "
        f"when w like '%ing' and {_has_vowel(f'{L} - 3')} then left(w, {L} - 3) else w end"
    )
    fired = (
        f"(w not like '%ied' and w not like '%eed' and ((w like '%ed' and {_has_vowel(f'{L} - 2')}) or "
        f"(w not like '%ed' and w like '%ing' and {_has_vowel(f'{L} - 3')})))"
    )
    s1b_extra = (
        f"case when not fired then w when w like '%at' or w like '%bl' or w like '%iz' then w || 'e' "
        f"when {_double(L)} and right(w, 1) not in ('l', 's', 'z') then left(w, {L} - 1) "
        f"when {_m(L)} = 1 and {_cvc(L)} then w || 'e' else w end"
    )
    s1c = f"case when w like '%y' and {L} > 2 and substr(cv, {L} - 1, 1) = 'c' then left(w, {L} - 1) || 'i' else w end"

    def table(rules, cond):
        parts = []
        for suf, rep in rules.items():
            n = f"{L} - {len(suf)}"
            parts.append(f"when w like '%{suf}' then (case when {_m(n)} {cond} then left(w, {n}) || '{rep}' else w end)")
        return "case " + " ".join(parts) + " else w end"

    alli = f"case when w like '%alli' and {_m(f'{L} - 4')} > 0 then left(w, {L} - 2) else w end"
    logi = f"when w like '%logi' then (case when {_m(f'{L} - 3')} > 0 then left(w, {L} - 1) else w end) else w end"
    s2 = table(STEP2, "> 0").removesuffix("else w end") + logi
    s3 = table(STEP3, "> 0")
    parts4 = []
    for suf in STEP4:
        n = f"{L} - {len(suf)}"
        extra = f" and substr(w, {n}, 1) in ('s', 't')" if suf == "ion" else ""
        parts4.append(f"when w like '%{suf}' then (case when {_m(n)} > 1{extra} then left(w, {n}) else w end)")
    s4 = "case " + " ".join(parts4) + " else w end"
    s5 = (
        f"case when w like '%e' then (case when {_m(f'{L} - 1')} > 1 or ({_m(f'{L} - 1')} = 1 and not {_cvc(f'{L} - 1')}) "
        f"then left(w, {L} - 1) else w end) "
        f"when {_m(L)} > 1 and {_double(L)} and w like '%l' then left(w, {L} - 1) else w end"
    )
    odd = " ".join(f"when token in ({', '.join(repr(w) for w in words.split())}) then '{stem}'" for stem, words in IRREGULAR.items())
    return f"""
p0 as (select distinct token, token as w from {tokens_cte}),
{_step('p1a', 'p0', s1a)},
p1b_cv as (select token, w, {_cv('w')} as cv from p1a),
p1b as (select token, case when length(token) <= 2 then w else {s1b} end as w,
               length(token) > 2 and {fired} as fired from p1b_cv),
p1x_cv as (select token, w, fired, {_cv('w')} as cv from p1b),
p1x as (select token, case when length(token) <= 2 then w else {s1b_extra} end as w from p1x_cv),
{_step('p1c', 'p1x', s1c)},
{_step('pal', 'p1c', alli)},
{_step('p2', 'pal', s2)},
{_step('p3', 'p2', s3)},
{_step('p4', 'p3', s4)},
{_step('p5', 'p4', s5)},
stems as (select token, case {odd} else w end as stem from p5)"""
