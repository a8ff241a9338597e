"""Linking the variant spellings of names typed by people.

Merge-and-rematch resolution. A profile is a set of records taken for one
person or organisation of a company: their spellings, dates and suffix. In
each round profiles are blocked by keys made from all of that; those that meet
in a block and do not contradict each other merge, which unions what they
hold; merged profiles get new keys, from spellings of one record with dates of
another and without those that a better spelling makes needless, and enter
blocking again, until no merge occurs. First only exact keys are made, so that
the many keys of near spellings are made once for a merged profile.

A spelling is parsed into surname, given name, initials, generation suffix, or
for organisations into a name and a legal form. Spellings with a full given
name (and organisations) are strong: they share a key when surname and given
name agree up to one edit, a nickname, a hyphen or a look-alike of typing. Two
different given names that are known, or two unknown ones with different
initials, keep a key from merging. A given name is known when it is listed
with short forms, or by frequency: it occurs at ``ESTABLISHED`` companies or
more and no similar one is ``DOMINANT`` times as frequent.
Spellings with initials or a surname only are weak: they follow a key only if
all strong spellings under it are one profile by now, or the start dates leave
one.

Suffixes and legal forms: profiles of different ones never merge. Profiles of
equal ones, or of none, merge first. A profile without one that then still
meets profiles with one follows them if all of them have the same, and stays
alone otherwise. Which merges happen depends on what profiles hold and on
nothing else.

Companies do not touch each other, so tasks work through all rounds of the
companies they hold, over arrays. A company of more than ``most`` profiles goes
round by round over all tasks, cut by written tables. Either way blocks are
worked on by aggregates over a key, in the tables combined before the shuffle
and by suffix first, never by pairs.

Defined results: blank, null and placeholder names, and records without a
company, are linked to nobody; repeated rows count once.
"""

from __future__ import annotations

import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.llm.canonical import canonical_text
from filigree.runtime import bound_batches, stage

# Common English short forms by formal given name.
SHORT_FORMS = {
    "alexandra": "alex sandra lexi sasha", "alexander": "alex al sandy", "andrew": "andy drew", "anthony": "tony", "barbara": "barb", "benjamin": "ben", "catherine": "cathy kate katie",
    "charles": "charlie chuck chas", "christine": "chris tina", "christopher": "chris kit", "daniel": "dan danny", "david": "dave", "deborah": "deb debbie", "donald": "don", "dorothy": "dot",
    "edward": "ed eddie ned ted", "elizabeth": "beth liz betty eliza lisa libby", "frances": "fran", "francis": "frank", "frederick": "fred", "gerald": "jerry", "gregory": "greg",
    "henry": "hank harry", "james": "jim jamie jimmy", "jeffrey": "jeff", "jennifer": "jen jenny", "john": "jack johnny", "joseph": "joe joey", "katherine": "kate kathy katie kat kathryn",
    "kenneth": "ken", "lawrence": "larry", "leonard": "len", "margaret": "maggie peggy meg", "matthew": "matt", "michael": "mike mick", "nicholas": "nick", "pamela": "pam",
    "patricia": "pat trish patty tricia", "patrick": "pat", "peter": "pete", "philip": "phil", "raymond": "ray", "rebecca": "becky becca", "richard": "rick dick rich", "robert": "rob bob bobby",
    "ronald": "ron", "samuel": "sam", "stephen": "steve", "steven": "steve", "susan": "sue susie", "theodore": "ted theo", "thomas": "tom tommy", "timothy": "tim", "victoria": "vicky tori",
    "vincent": "vince", "walter": "walt", "william": "will bill billy liam",
}
# Words of English names and of English filings.
HONORIFICS = set("mr mrs ms miss mx dr prof hon sir dame rev mister".split())
DEGREES = set("cpa cfa phd md jd mba esq esquire llm dds msc bsc cma retired ret".split())
SUFFIXES = {"jr": "jr", "junior": "jr", "sr": "sr", "senior": "sr", "ii": "2", "iii": "3", "iv": "4", "2nd": "2", "3rd": "3"}
LEGAL = {"corp": "corp", "corporation": "corp", "inc": "inc", "incorporated": "inc", "co": "co", "company": "co", "ltd": "ltd", "limited": "ltd", "llp": "llp", "llc": "llc", "lp": "lp", "plc": "plc"}
TRADES = set("advisory audit bancorp bank capital consulting counsel fund group holdings insurance partners services transfer trust trustees".split())
PLACEHOLDERS = set("unknown na none null nil tbd tba same various vacant undisclosed notdisclosed notavailable notapplicable thecompany company theregistrant registrant management seeabove asabove name anonymous xxx test".split())
MONTHS = {m: f"{i:02d}" for i, m in enumerate("january february march april may june july august september october november december".split(), 1)}

_SHORT: dict[str, set[str]] = {}
for _formal, _shorts in SHORT_FORMS.items():
    for _s in [_formal, *_shorts.split()]:
        _SHORT.setdefault(_s, set()).add(_formal)


def fold(text: str) -> str:
    """Lower case without accents; brackets and what they hold go."""
    text = unicodedata.normalize("NFKD", canonical_text(text) or "")
    return re.sub(r"\([^)]*\)", " ", "".join(c for c in text if not unicodedata.combining(c)).lower().replace("ß", "ss").replace("ø", "o").replace("æ", "ae"))


def untyped(word: str) -> str:
    """One form for letters that are mistaken for each other on paper: rn and m, vv and w, 1 and l, 0 and o, 5 and s."""
    if re.search("[a-z]", word):
        word = word.translate(str.maketrans("105", "los"))
    return word.replace("rn", "m").replace("vv", "w")


def sounded(word: str) -> str:
    """One form for spellings of a surname or a firm that sound alike."""
    return word.replace("ph", "f").replace("ck", "k").replace("y", "i").replace("z", "s")


def formal(given: str) -> set[str]:
    return _SHORT.get(given, {given})


def parse(name: str | None) -> tuple[str, str, str, str] | None:
    """(kind, surname or name, given or words of the name, suffix or legal form); kind is full, initial, surname or org; None means nobody."""
    if not name:
        return None
    text = fold(name)
    joint = bool(re.search(r"[&+]|\band\b", text))
    text = re.sub(r"\b([a-z])\.\s?(?=[a-z]\.)", r"\1", text) if re.search(r"\b(?:l\.\s?l\.\s?[pc]|ph\.\s?d|m\.\s?d|j\.\s?d|p\.\s?l\.\s?c|l\.\s?p)\b", text) else text
    parts = [re.findall(r"[a-z0-9]+(?:['-][a-z0-9]+)*", p.replace("’", "'")) for p in text.split(",")]
    words = [w for p in parts for w in p]
    if not words or "".join(words) in PLACEHOLDERS or not re.search(r"[a-z]", "".join(words)):
        return None
    legal = [LEGAL[w] for w in words[1:] if w in LEGAL]
    if legal or joint or any(w in TRADES for w in words[1:]):
        core = [w if w in TRADES else sounded(untyped(w.replace("-", ""))) for w in words if w not in LEGAL and w not in ("the", "and")]
        return ("org", "".join(core), " ".join(core), legal[-1] if legal else "") if core else None
    suffix = next((SUFFIXES[w] for w in words if w in SUFFIXES), "")
    drop = HONORIFICS | DEGREES | SUFFIXES.keys()
    if re.search(r"\bph\.?\s?d\b", text):
        drop = drop | {"ph", "d", "phd"} if len(words) > 3 else drop | {"phd"}
    parts = [p for p in ([w for w in p if w not in drop] for p in parts) if p]
    if not parts:
        return None
    if len(parts) > 1:
        surname, rest = parts[0], [w for p in parts[1:] for w in p]
    else:
        surname, rest = [], parts[0]
        while rest and not surname:
            surname = [w for i, w in enumerate(rest) if i and len(w) > 1] or [rest[-1]]
            rest = [w for i, w in enumerate(rest) if i == 0 or len(w) == 1] if len(rest) > 1 else []
    last = sounded(untyped("".join(surname).replace("-", "").replace("'", "")))
    if len(last) < 2:
        return None
    given = untyped(rest[0].replace("-", "")) if rest else ""
    if rest and len(given) == 1:
        full = next((w for w in rest[1:] if len(w) > 1), "")
        if full and len(parts) > 1:
            given = untyped(full)
    if not given:
        return "surname", last, "", suffix
    return ("full" if len(given) > 1 else "initial"), last, given, suffix


def start(text: str | None) -> str:
    """A start date as far as it is told: yyyy, yyyy-mm or yyyy-mm-dd; empty where it is none."""
    t = (text or "").strip().lower()
    if m := re.fullmatch(r"(\d{4})(?:-(\d\d))?(?:-(\d\d))?", t):
        return t
    if (m := re.fullmatch(r"([a-z]+),? (\d{4})", t)) and m[1] in MONTHS:
        return f"{m[2]}-{MONTHS[m[1]]}"
    return ""


def deletions(word: str) -> list[str]:
    """The word and all that one letter less leaves of it: two words share one if an edit or a swap parts them."""
    return [word, *{word[:i] + word[i + 1 :] for i in range(len(word))}] if len(word) > 3 else [word]


def _levels(date: str) -> list[str]:
    return [date[:n] for n in (4, 7, 10) if len(date) >= n]


def _near_given(given: str) -> set[str]:
    """The name and all that one or two letters less leave of it, with its first letter, so that two names within two edits share one."""
    one = {given[:i] + given[i + 1 :] for i in range(1, len(given))}
    return {given} | one | {w[:i] + w[i + 1 :] for w in one for i in range(1, len(w))}


ESTABLISHED, DOMINANT = 5, 10
STRONG, CANDIDATE, WEAK = 0, 1, 2
#: Order in which a weak spelling takes its keys.
EXACT, EXACT_DATED, NEAR, NEAR_DATED = 0, 1, 2, 3
#: What is known of a given name: nothing, that it is one, that it is one mistyped.
UNKNOWN, KNOWN, MISTYPED = 0, 1, 2

Form = tuple[str, str, str, str, int]


def exact_keys(forms: list[Form], dates: list[str]) -> list[tuple[int, str, int, int, str]]:
    """(spelling, key, role, rung, mark) of the spellings that agree letter for letter but for nicknames."""
    out = []
    for i, (kind, last, given, _, _) in enumerate(forms):
        if kind == "org":
            out.append((i, f"o|{last}", STRONG, 0, ""))
        elif kind == "full":
            out += [(i, f"f|{last}|{n}", STRONG, 0, "") for n in sorted(formal(given))]
    return list(dict.fromkeys(out))


def keys_of(forms: list[Form], dates: list[str]) -> list[tuple[int, str, int, int, str]]:
    """(spelling, key, role, rung, mark) of a profile of one or more spellings and start dates.

    The mark is the given name where it is known, ``?`` and its initial where it is not.
    """
    out = []
    firm = {f[1] for f in forms if f[0] == "full"}
    some = firm | {f[1] for f in forms if f[0] == "initial"}
    levels = sorted({x for d in dates for x in _levels(d)})
    years = [x for x in levels if len(x) == 4]
    for i, (kind, last, given, _, state) in enumerate(forms):
        if kind == "org":
            out += [(i, f"o|{d}", STRONG, 0, "") for d in (deletions(last) if len(last) > 5 else [last])]
            # two edits in one word: another main word and the trade still agree
            *main, trade = given.split()
            if trade in TRADES and len(main) > 1:
                out += [(i, f"w|{d}|{trade}", STRONG, 0, "") for w in main if len(w) > 4 for d in deletions(w)]
            continue
        near = deletions(last)
        if kind == "full":
            names = sorted(formal(given))
            sure = given in _SHORT or state == KNOWN
            mark = names[0] if len(names) == 1 and sure else "" if sure else f"?{given[0]}"
            for n in names:
                out += [(i, f"f|{d}|{n}", STRONG, 0, "") for d in near]
                out += [(i, f"d|{last}|{n}|{x}", STRONG, 0, "") for x in levels]
            spelled = {given, *(x for n in names if sure for x in (n, *SHORT_FORMS.get(n, "").split()))}
            out += [(i, f"g|{last}|{d}", STRONG, 0, mark) for x in spelled if len(x) > 3 for d in deletions(x)]
            letters = {given[0], *(n[0] for n in names)}
            role, dated = CANDIDATE, years
            sorts = [f"i{x}" for x in letters] + ["s"]
        elif kind == "initial":
            sorts, role, dated = [f"i{given[0]}"], WEAK, years
            if last not in firm:
                for x in ["", *(f"|{x}" for x in years)]:
                    out.append((i, f"s|{last}{x}", CANDIDATE, EXACT_DATED if x else EXACT, ""))
                    out += [(i, f"~s|{d}{x}", CANDIDATE, NEAR_DATED if x else NEAR, "") for d in near]
        else:
            sorts, role, dated = ["s"], WEAK, years
        if role == WEAK and last in (firm if kind == "initial" else some):
            continue
        # a mistyped given name is looked up by its initial, and stands for its person where there is no better spelling
        doubt = "?" if kind == "full" and state == MISTYPED else ""
        for s in sorts:
            for as_ in (role, WEAK) if doubt and s != "s" else (role,):
                out.append((i, f"{s}|{last}", as_, EXACT, doubt))
                out += [(i, f"{s}|{last}|{x}", as_, EXACT_DATED, doubt) for x in dated]
                out += [(i, f"~{s}|{d}", as_, NEAR, doubt) for d in near]
                out += [(i, f"~{s}|{d}|{x}", as_, NEAR_DATED, doubt) for d in near for x in dated]
    return list(dict.fromkeys(out))


PROFILE = "profile bigint, company string, forms array<struct<kind:string,last:string,given:string,suffix:string>>, date string"
_FORM = "struct<kind:string,last:string,given:string,suffix:string,state:int>"
KEY = "entity bigint, suffix int, form int, key bigint, role int, rung int, known bigint, unknown bigint, doubt boolean, dated boolean"


def _profiles(batches):
    """Rows (id, company, names, date) to (id, profile, company, forms, date), of those that name somebody."""
    memo: dict[str, tuple | None] = {}
    form = pa.list_(pa.struct([(x, pa.string()) for x in ("kind", "last", "given", "suffix")]))
    for b in batches:
        index, profiles, forms, dates = [], [], [], []
        for i, (company, names, date) in enumerate(zip(b.column("company").to_pylist(), b.column("names").to_pylist(), b.column("date").to_pylist())):
            found = set()
            for n in names or ():
                if n not in memo:
                    if len(memo) > 200_000:
                        memo.clear()
                    memo[n] = parse(n)
                if memo[n]:
                    found.add(memo[n])
            if not found:
                continue
            when, ordered = start(date), sorted(found)
            index.append(i)
            profiles.append(xxhash.xxh3_64_intdigest(repr((company, ordered, when)).encode()) >> 1)
            forms.append([dict(zip(("kind", "last", "given", "suffix"), f)) for f in ordered])
            dates.append(when)
        take = pa.array(index, pa.int64())
        yield pa.record_batch([b.column("id").take(take), pa.array(profiles, pa.int64()), b.column("company").take(take), pa.array(forms, form), pa.array(dates, pa.string())], ["id", "profile", "company", "forms", "date"])


def _key_columns(holders, near: bool) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The place of each key's holder (company, forms, dates), and the columns of ``KEY`` from form on, absent signs -1."""
    make, digest = keys_of if near else exact_keys, xxhash.xxh3_64_intdigest
    place, dated, marks = array("q"), array("b"), {}
    form, key, role, rung, mark = (array("q") for _ in range(5))
    for i, (company, forms, dates) in enumerate(holders):
        made = make(sorted(forms), dates)
        if not made:
            continue
        some, names, roles, rungs, said = zip(*made)
        place.extend([i] * len(made))
        dated.extend([bool(dates)] * len(made))
        form.extend(some)
        key.extend([digest(f"{company}|{x}".encode()) - (1 << 63) for x in names])
        role.extend(roles)
        rung.extend(rungs)
        mark.extend([marks.setdefault(x, len(marks)) for x in said])
    signs = np.array([digest(x) >> 1 if x.strip("?") else -1 for x in marks], np.int64)
    sure, doubt, of = np.array([not x.startswith("?") for x in marks], bool), np.array([x == "?" for x in marks], bool), np.array(mark, np.int64)
    known, unknown = np.where(sure, signs, -1), np.where(sure, -1, signs)
    return np.array(place), {"form": np.array(form), "key": np.array(key), "role": np.array(role), "rung": np.array(rung), "known": known[of], "unknown": unknown[of], "doubt": doubt[of], "dated": np.array(dated).astype(bool)}


def _make_keys(near: bool):
    """Rows (entity, company, forms, dates, suffix) to ``KEY``."""

    def work(batches):
        for b in batches:
            companies, forms, dates = (b.column(c).to_pylist() for c in ("company", "forms", "dates"))
            take, cols = _key_columns(((c, {tuple(f.values()) for f in fs}, d) for c, fs, d in zip(companies, forms, dates)), near)
            small = {c: pa.array(cols[c], pa.int32()) for c in ("form", "role", "rung")}
            signs = {c: pa.array(cols[c], mask=cols[c] < 0) for c in ("known", "unknown")}
            cols = {"entity": b.column("entity").take(pa.array(take)), "suffix": b.column("suffix").take(pa.array(take))} | cols | small | signs
            yield pa.record_batch([pa.array(c) for c in cols.values()], list(cols))

    return work


def _deleted(batches):
    for b in batches:
        rows = [(i, k) for i, g in enumerate(b.column("given").to_pylist()) for k in _near_given(g)]
        index, keys = zip(*rows) if rows else ((), ())
        take = pa.array(index, pa.int64())
        yield pa.record_batch([b.column("given").take(take), b.column("n").take(take), pa.array(keys, pa.string())], ["given", "n", "key"])


def given_states(profiles: DataFrame) -> DataFrame:
    """(given, state): the given names without short forms that are known, or mistyped, by the companies at which they occur."""
    full = profiles.select("company", F.explode("forms").alias("f")).where("f.kind = 'full'").select("company", F.col("f.given").alias("given")).distinct()
    counts = stage(full.groupBy("given").agg(F.count("*").alias("n")), label="given-names")
    listed = profiles.sparkSession.createDataFrame([(x,) for x in sorted(_SHORT)], "given string")
    counted = counts.join(listed.withColumn("listed", F.lit(True)), "given", "full").select("given", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("listed", F.lit(False)).alias("listed"))
    keyed = counted.select("given", "n").mapInArrow(_deleted, "given string, n bigint, key string")
    firm = keyed.join(counted.where((F.col("n") >= ESTABLISHED) | F.col("listed")).select("given", "listed"), "given").select(F.col("given").alias("other"), F.col("n").alias("m"), "listed", "key")
    near = keyed.join(firm, "key").where("given <> other and levenshtein(given, other, 2) >= 0").select("given", "n", "other", "m", "listed").distinct()
    beaten = near.where(F.col("m") >= DOMINANT * F.col("n")).select("given").distinct()
    known = stage(counted.where((F.col("n") >= ESTABLISHED) & ~F.col("listed")).select("given").join(beaten, "given", "left_anti"), label="known-given-names")
    alike = near.join(known.select(F.col("given").alias("other"), F.lit(True).alias("is_known")), "other", "left").where("(listed or is_known) and length(other) > 3 and length(given) > 3")
    mistyped = alike.select("given").distinct().join(known.unionByName(listed), "given", "left_anti")
    return known.withColumn("state", F.lit(KNOWN)).unionByName(mistyped.withColumn("state", F.lit(MISTYPED)))


def _links(keys: DataFrame) -> DataFrame:
    """(entity, sa, to): who may merge with whom, with the first one's suffix, 0 for none."""
    firm = F.col("role") < WEAK
    good = firm & ~F.col("doubt")
    strong = F.col("role") == STRONG
    suffixed = F.col("suffix") > 0
    pick = lambda f, cond, c="entity": f(F.when(cond, F.col(c)))
    # numbers only, so that all of it is hashed
    by_suffix = keys.groupBy("key", "suffix").agg(
        F.min("entity").alias("lo"), F.max("entity").alias("hi"), pick(F.min, firm).alias("firm_lo"), pick(F.max, firm).alias("firm_hi"), pick(F.min, good).alias("good_lo"), pick(F.max, good).alias("good_hi"),
        F.max(F.when(firm, F.col("dated").cast("int"))).alias("dated"), pick(F.min, strong).alias("own"),
        F.min("known").alias("k_lo"), F.max("known").alias("k_hi"), F.min("unknown").alias("u_lo"), F.max("unknown").alias("u_hi"),
    )
    by_key = by_suffix.groupBy("key").agg(
        *[F.min(c).alias(c) for c in ("lo", "firm_lo", "good_lo", "k_lo", "u_lo")], *[F.max(c).alias(c) for c in ("hi", "firm_hi", "good_hi", "k_hi", "u_hi")], F.max("dated").alias("any_dated"),
        F.min(F.when(suffixed, F.col("suffix"))).alias("s_lo"), F.max(F.when(suffixed, F.col("suffix"))).alias("s_hi"), F.min(F.when(suffixed, F.col("own"))).alias("own_with"), F.min(F.when(~suffixed, F.col("own"))).alias("own_bare"),
    )
    apart = F.coalesce(F.col("s_lo") != F.col("s_hi"), F.lit(False))
    names_apart = F.coalesce(F.col("k_lo") != F.col("k_hi"), F.lit(False)) | F.coalesce(F.col("u_lo") != F.col("u_hi"), F.lit(False))
    by_key = by_key.where("lo <> hi").withColumns({"apart": apart, "names_apart": names_apart})
    told = keys.where(strong).select("entity", "key", "suffix").join(by_key.where("not names_apart").select("key", "apart", "own_with", "own_bare"), "key")
    # profiles of one kind meet their like, those without a suffix also those with the only one there is
    plain = told.where("not apart").select("entity", F.col("suffix").alias("sa"), F.explode(F.array(F.when(suffixed, F.col("own_with")).otherwise(F.col("own_bare")), F.when(~suffixed, F.col("own_with")))).alias("to"))
    several = told.where(F.col("apart") & suffixed).join(by_suffix.select("key", "suffix", "own"), ["key", "suffix"]).select("entity", F.col("suffix").alias("sa"), F.col("own").alias("to"))
    # weak spellings: the rungs of their keys side by side
    seen = keys.where(F.col("role") == WEAK).join(by_key, "key")
    doubt = F.col("doubt")
    seen = seen.withColumns({"c_lo": F.when(doubt, F.col("good_lo")).otherwise(F.col("firm_lo")), "c_hi": F.when(doubt, F.col("good_hi")).otherwise(F.col("firm_hi"))})
    seen = seen.withColumn("suits", ((~suffixed | F.col("s_lo").isNull() | (F.col("s_lo") == F.col("suffix"))) & ~F.col("apart")).cast("int"))
    at = lambda c, rung, f: f(F.when(F.col("rung") == rung, F.col(c)))
    one = seen.groupBy("entity", "form").agg(
        F.max("suffix").alias("sa"),
        *[at("c_lo", r, F.min).alias(f"lo{r}") for r in range(4)], *[at("c_hi", r, F.max).alias(f"hi{r}") for r in range(4)],
        F.min(F.when((F.col("rung") == EXACT) & ~doubt, F.col("lo"))).alias("alone"), F.max(F.col("dated").cast("int")).alias("dated"), F.max(F.when(F.col("rung").isin(EXACT, NEAR), F.col("any_dated"))).alias("others_dated"),
        F.min(F.when(F.col("rung") == EXACT, F.col("suits"))).alias("suits"),
    )
    unique = lambda r: F.col(f"lo{r}") == F.col(f"hi{r}")
    # the others tell dates and none of them is of the same year
    veto = (F.col("dated") == 1) & (F.coalesce("others_dated", F.lit(0)) == 1) & F.col("lo1").isNull() & F.col("lo3").isNull()
    exact = F.when(unique(EXACT) & ~veto, F.col("lo0")).when(unique(EXACT_DATED), F.col("lo1"))
    near = F.when(unique(NEAR) & ~veto, F.col("lo2")).when(unique(NEAR_DATED), F.col("lo3"))
    to = F.when(F.col("lo0").isNotNull(), exact).when(F.col("lo2").isNotNull(), near).otherwise(F.col("alone"))
    weak = one.where(F.coalesce("suits", F.lit(1)) == 1).select("entity", "sa", to.alias("to"))
    return plain.unionByName(several).unionByName(weak).where("to <> entity").distinct()


def _moves(keys: DataFrame, entities: DataFrame, near: bool) -> DataFrame:
    """(entity, to): who merges into whom in this round."""
    links = _links(keys).join(entities.select(F.col("entity").alias("to"), F.col("suffix").alias("sb")), "to")
    links = stage(links.where("sa = sb or least(sa, sb) = 0"), label="name-links")
    same = links.where("sa = sb").select("entity", "to")
    if near:
        # from the side without a suffix; it waits while it merges with its like, and follows one suffix only
        first = F.col("sa") == 0
        bare = links.where("sa <> sb").select(F.when(first, F.col("entity")).otherwise(F.col("to")).alias("bare"), F.when(first, F.col("to")).otherwise(F.col("entity")).alias("with"), F.greatest("sa", "sb").alias("suffix"))
        busy = same.select(F.explode(F.array("entity", "to")).alias("bare")).distinct()
        sure = bare.groupBy("bare").agg(F.min("suffix").alias("s"), F.max("suffix").alias("t")).where("s = t").select("bare").join(busy, "bare", "left_anti")
        same = same.unionByName(bare.join(sure, "bare").select(F.col("bare").alias("entity"), F.col("with").alias("to")))
    moves = same.groupBy(F.greatest("entity", "to").alias("entity")).agg(F.min(F.least("entity", "to")).alias("to"))
    # a target that moves itself takes its followers along
    beyond = moves.select(F.col("entity").alias("to"), F.col("to").alias("beyond"))
    return moves.join(beyond, "to", "left").select("entity", F.coalesce("beyond", "to").alias("to"))


_KINDS = sorted({*SUFFIXES.values(), *LEGAL.values()})


def _one_suffix(forms: str) -> Column:
    """The number of the suffix of all spellings that have one, 0 where there is none or two."""
    said = F.array_distinct(F.filter(F.transform(forms, lambda f: f["suffix"]), lambda x: x != ""))
    return F.when(F.size(said) == 1, F.array_position(F.array(*map(F.lit, _KINDS)), said[0]).cast("int")).otherwise(F.lit(0))


def _settled_by_rounds(entities: DataFrame, max_rounds: int) -> DataFrame:
    """The same as ``_settled``, each round written tables, for companies that no task may hold.

    Each round looks at all keys: what a profile without a suffix follows
    depends on all that it meets, not only on those with news.
    """
    labels = entities.select(F.col("entity").alias("profile"), "entity")
    count, rounds, history = entities.count(), 0, []
    for near in (False, True):
        made = lambda df, n: stage(_spread(df, n).mapInArrow(_make_keys(near), KEY), label="name-keys")  # noqa: E731, B023
        keys = made(entities, count)
        while True:
            rounds += 1
            if rounds > max_rounds:
                raise RuntimeError(f"names still merged after {max_rounds} rounds")
            moves = stage(_moves(keys, entities, near), label="name-moves")
            merged = moves.count()
            if not merged:
                break
            history.append(moves)
            touched = moves.select(F.explode(F.array("entity", "to")).alias("entity")).distinct()
            changed = entities.join(touched, "entity", "left_semi").join(moves, "entity", "left").select(F.coalesce("to", "entity").alias("entity"), "company", "forms", "dates")
            changed = changed.groupBy("entity").agg(F.first("company").alias("company"), F.array_distinct(F.flatten(F.collect_list("forms"))).alias("forms"), F.array_distinct(F.flatten(F.collect_list("dates"))).alias("dates"))
            changed = stage(changed.select("entity", "company", "forms", "dates", _one_suffix("forms").alias("suffix")), label="name-entities")
            entities = stage(entities.join(touched, "entity", "left_anti").unionByName(changed), label="name-entities")
            if not near:
                # what is left of these merges comes with the others
                break
            keys = stage(keys.join(touched, "entity", "left_anti").unionByName(made(changed, merged)), label="name-keys")
    for moves in history:
        labels = labels.join(moves, "entity", "left").select("profile", F.coalesce("to", "entity").alias("entity"))
    return stage(labels, label="name-labels")


#: Above every place of a profile and every sign: what the least of none is.
NOBODY = np.iinfo(np.int64).max


def _runs(*cols: np.ndarray) -> np.ndarray:
    """Where rows sorted by these columns begin to differ from the row before."""
    new = np.ones(len(cols[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return np.flatnonzero(new)


def _least(x: np.ndarray, where: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(np.where(where, x, NOBODY), at)


def _greatest(x: np.ndarray, where: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.maximum.reduceat(np.where(where, x, -1), at)


def _links_at_hand(keys: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_links`` over arrays; entities are places, absent signs -1."""
    order = np.lexsort((keys["suffix"], keys["key"]))
    key, entity = keys["key"][order], keys["entity"][order]
    at = _runs(key) if len(key) else np.zeros(0, np.int64)
    if len(at):
        several = np.minimum.reduceat(entity, at) != np.maximum.reduceat(entity, at)
        order = order[np.repeat(several, np.diff(at, append=len(key)))]
    if not len(at) or not len(order):
        return (np.zeros(0, np.int64),) * 3
    key, entity, suffix, role, rung, known, unknown, doubt, dated, form = (keys[c][order] for c in ("key", "entity", "suffix", "role", "rung", "known", "unknown", "doubt", "dated", "form"))
    at, by_suffix = _runs(key), _runs(key, suffix)
    of = np.repeat(np.arange(len(at)), np.diff(at, append=len(key)))
    own = np.repeat(np.arange(len(by_suffix)), np.diff(by_suffix, append=len(key)))
    firm, strong, suffixed = role < WEAK, role == STRONG, suffix > 0
    good = firm & ~doubt
    lo = np.minimum.reduceat(entity, at)
    any_dated = _greatest(dated.astype(np.int64), firm, at)
    s_lo, s_hi = _least(suffix, suffixed, at), _greatest(suffix, suffixed, at)
    apart = (s_lo < s_hi)[of]
    names_apart = (_least(known, known >= 0, at) < _greatest(known, known >= 0, at)) | (_least(unknown, unknown >= 0, at) < _greatest(unknown, unknown >= 0, at))
    own, own_with, own_bare = _least(entity, strong, by_suffix)[own], _least(entity, strong & suffixed, at)[of], _least(entity, strong & ~suffixed, at)[of]
    told = strong & ~names_apart[of]
    plain, bare, parted = told & ~apart, told & ~apart & ~suffixed, told & apart & suffixed
    links = [(entity[plain], suffix[plain], np.where(suffixed, own_with, own_bare)[plain]), (entity[bare], suffix[bare], own_with[bare]), (entity[parted], suffix[parted], own[parted])]
    seen = np.flatnonzero(role == WEAK)
    if len(seen):
        seen = seen[np.lexsort((form[seen], entity[seen]))]
        c_lo = np.where(doubt, _least(entity, good, at)[of], _least(entity, firm, at)[of])[seen]
        c_hi = np.where(doubt, _greatest(entity, good, at)[of], _greatest(entity, firm, at)[of])[seen]
        suits = ((~suffixed | (s_lo[of] == NOBODY) | (s_lo[of] == suffix)) & ~apart)[seen].astype(np.int64)
        low, others, doubt, rung = lo[of][seen], any_dated[of][seen], doubt[seen], rung[seen]
        one = _runs(entity[seen], form[seen])
        los, his = [_least(c_lo, rung == r, one) for r in range(4)], [_greatest(c_hi, rung == r, one) for r in range(4)]
        alone = _least(low, (rung == EXACT) & ~doubt, one)
        others = _greatest(others, (rung == EXACT) | (rung == NEAR), one) == 1
        # the others tell dates and none of them is of the same year
        veto = dated[seen][one] & others & (los[EXACT_DATED] == NOBODY) & (los[NEAR_DATED] == NOBODY)
        unique = [a == b for a, b in zip(los, his)]
        exact = np.where(unique[EXACT] & ~veto, los[EXACT], np.where(unique[EXACT_DATED], los[EXACT_DATED], NOBODY))
        near = np.where(unique[NEAR] & ~veto, los[NEAR], np.where(unique[NEAR_DATED], los[NEAR_DATED], NOBODY))
        to = np.where(los[EXACT] != NOBODY, exact, np.where(los[NEAR] != NOBODY, near, alone))
        to = np.where(_least(suits, rung == EXACT, one) != 0, to, NOBODY)
        links.append((entity[seen][one], suffix[seen][one], to))
    entity, sa, to = (np.concatenate(x) for x in zip(*links))
    some = (to != NOBODY) & (to != entity)
    return entity[some], sa[some], to[some]


def _moves_at_hand(keys: dict[str, np.ndarray], suffix: np.ndarray, near: bool) -> np.ndarray:
    """``_moves`` over arrays: where each entity goes, itself where it stays."""
    entity, sa, to = _links_at_hand(keys)
    sb = suffix[to]
    same, other = sa == sb, (sa != sb) & (np.minimum(sa, sb) == 0)
    a, b = entity[same], to[same]
    if near:
        first = sa[other] == 0
        bare, beside, kind = np.where(first, entity[other], to[other]), np.where(first, to[other], entity[other]), np.maximum(sa, sb)[other]
        least, most, busy = np.full(len(suffix), NOBODY), np.full(len(suffix), -1), np.zeros(len(suffix), bool)
        np.minimum.at(least, bare, kind)
        np.maximum.at(most, bare, kind)
        busy[a] = busy[b] = True
        sure = ((least == most) & ~busy)[bare]
        a, b = np.concatenate([a, bare[sure]]), np.concatenate([b, beside[sure]])
    target = np.arange(len(suffix))
    np.minimum.at(target, np.maximum(a, b), np.minimum(a, b))
    return target[target]


def _settle(rows: list[tuple], max_rounds: int) -> tuple[list[int], list[int]]:
    """Profiles and their entities, of rows (entity, company, forms, dates, suffix) of whole companies."""
    rows = sorted(rows, key=lambda r: r[0])  # places are ordered as the ids are
    ids, companies, forms, dates, suffix = map(list, zip(*rows))
    forms, dates, suffix = [{tuple(f.values()) for f in x} for x in forms], [set(x) for x in dates], np.array(suffix, np.int64)
    of_company = np.unique(companies, return_inverse=True)[1]
    label, rounds = np.arange(len(ids)), 0
    for near in (False, True):

        def made(some):
            take, cols = _key_columns(((companies[i], forms[i], dates[i]) for i in some.tolist()), near)  # noqa: B023
            entity = some[take]
            return {"entity": entity, "suffix": suffix[entity]} | cols

        keys = made(np.unique(label))
        while True:
            rounds += 1
            if rounds > max_rounds:
                raise RuntimeError(f"names still merged after {max_rounds} rounds")
            to = _moves_at_hand(keys, suffix, near)
            moved = np.flatnonzero(to != np.arange(len(ids)))
            if not len(moved):
                break
            touched = np.union1d(moved, to[moved])
            held = [(int(to[i]), forms[i], dates[i]) for i in touched.tolist()]
            for i in touched.tolist():
                forms[i], dates[i] = set(), set()
            for i, f, d in held:
                forms[i] |= f
                dates[i] |= d
            changed = np.unique(to[touched])
            for i in changed.tolist():
                said = {f[3] for f in forms[i] if f[3]}
                suffix[i] = _KINDS.index(said.pop()) + 1 if len(said) == 1 else 0
            label = to[label]
            if not near:
                break
            # a company without news is done
            news, fresh = np.zeros(of_company.max() + 1, bool), np.zeros(len(ids), bool)
            news[of_company[touched]], fresh[touched] = True, True
            rest, new = news[of_company[keys["entity"]]] & ~fresh[keys["entity"]], made(changed)
            keys = {c: np.concatenate([x[rest], new[c]]) for c, x in keys.items()}
    return ids, [ids[i] for i in label.tolist()]


#: Profiles that a task works through at a time, as far as whole companies allow.
LOT = 1_000
#: Profiles of a company up to which a task settles it, about 13 KB each with their keys.
MOST_PROFILES = 10_000


def _settled(max_rounds: int):
    """Rows (entity, company, forms, dates, suffix) sorted by company to (profile, entity)."""

    def work(batches):
        def settled(rows):
            return pa.record_batch([pa.array(x, pa.int64()) for x in _settle(rows, max_rounds)], ["profile", "entity"])

        lot: list[tuple] = []
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("entity", "company", "forms", "dates", "suffix"))):
                if len(lot) >= LOT and row[1] != lot[-1][1]:
                    yield settled(lot)
                    lot = []
                lot.append(row)
        if lot:
            yield settled(lot)

    return work


def resolve(records: DataFrame, max_rounds: int = 60, most: int = MOST_PROFILES) -> DataFrame:
    """(id, entity): records (id bigint, company string, names array<string>, date string) that mean the same have one entity."""
    spark = records.sparkSession
    bound_batches(spark)
    usable = records.where("id is not null and company is not null").select("id", "company", "names", "date").distinct()
    rows = stage(usable.mapInArrow(_profiles, f"id bigint, {PROFILE}"), label="name-profiles")
    members = rows.select("id", "profile").distinct()
    profiles = rows.drop("id").dropDuplicates(["profile"])
    states = given_states(profiles)
    forms = profiles.select("profile", "company", "date", F.explode("forms").alias("f")).withColumn("given", F.when(F.col("f.kind") == "full", F.col("f.given")))
    told = forms.join(states, "given", "left").select("profile", "company", "date", F.struct("f.*", F.coalesce("state", F.lit(UNKNOWN)).alias("state")).cast(_FORM).alias("f"))
    entities = told.groupBy("profile").agg(F.first("company").alias("company"), F.collect_set("f").alias("forms"), F.first("date").alias("date"))
    entities = entities.select(F.col("profile").alias("entity"), "company", "forms", F.when(F.col("date") == "", F.array().cast("array<string>")).otherwise(F.array("date")).alias("dates"), _one_suffix("forms").alias("suffix"))
    entities = stage(entities, label="name-entities")
    sizes = stage(entities.groupBy("company").agg(F.count("*").alias("n")), label="company-sizes")
    count, large = sizes.agg(F.sum("n"), F.count_if(F.col("n") > most)).first()
    small = entities
    if large:
        beyond = sizes.where(F.col("n") > most).select("company")
        small = entities.join(beyond, "company", "left_anti").select(*entities.columns)
    labels = _spread(small, count or 0, "company").sortWithinPartitions("company").mapInArrow(_settled(max_rounds), "profile bigint, entity bigint")
    labels = stage(labels, label="name-labels")
    if large:
        labels = labels.unionByName(_settled_by_rounds(stage(entities.join(beyond, "company", "left_semi").select(*entities.columns), label="name-entities"), max_rounds))
    return members.join(labels, "profile").select("id", "entity").distinct()


PROFILES_A_TASK, PROFILES_WORTH_A_TASK = 20_000, 500


def _spread(df: DataFrame, n: int, by: str = "entity") -> DataFrame:
    """Few bytes become many keys: the tasks are as many as the profiles ask for, not their bytes."""
    tasks = max(-(-n // PROFILES_A_TASK), min(df.sparkSession.sparkContext.defaultParallelism, -(-n // PROFILES_WORTH_A_TASK)), 1)
    return df.repartition(tasks, by)


PAIR_BLOCK = 2_000


def linked_pairs(entities: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every two records of one entity; those of large entities in blocks."""
    sizes = entities.groupBy("entity").agg(F.count("*").alias("n")).where("n > 1").select("entity", F.ceil(F.col("n") / PAIR_BLOCK).cast("int").alias("blocks"))
    several = entities.join(sizes, "entity")
    a = several.select("entity", F.col("id").alias("id_a"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
    b = several.select("entity", F.col("id").alias("id_b"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    return a.join(b, ["entity", "block"]).where("id_a < id_b").select("id_a", "id_b").distinct()
