"""Text functions on columns. All stay in generated code: no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Function words of four letters or more (shorter ones never are tokens), in the five main languages of the feeds.
STOPWORDS = sorted(set("""
about above after again against also among been before being below between both could does doing down during each even ever every
from further have having here hers herself himself into itself just like many more most much must myself only other others ours
over said same shall should since some such than that their theirs them themselves then there these they this those through under
until upon very were what when where which while whom whose will with within without would your yours yourself
aber alle allem allen aller alles also andere anderen auch beim bereits dann dass dein deine denn dessen dich diese diesem diesen
dieser dieses doch dort durch eine einem einen einer eines etwa euch haben hatte hatten hier ihre ihrem ihren ihrer immer jede jedem
jeden jeder jedes jetzt kann kein keine mehr mein meine muss nach nicht noch oder ohne schon sehr sein seine seinem seinen seiner
sich sind soll sowie über unter viel vom wann warum weil wenn werden wird wurde wurden zwischen
ainsi alors après aucun aussi autre autres avant avec avoir cela celle celles celui cette ceux chaque comme contre dans depuis donc
dont elle elles encore entre était étaient être fait leur leurs lors mais même moins nous notre pour quand quel quelle quelles quels
sans selon sera sont sous toujours tous tout toute toutes très vers votre vous
algo algunas algunos ante antes aquel aquella como contra cual cuando desde donde durante ella ellas ellos entre eran esta estaba
estado estas este esto estos fueron había hacia hasta mientras mucho muchos nada otra otras otro otros para pero poco porque puede
quien según sido sobre solo también tanto tiene tienen toda todas todo todos unas unos
ainda alguns assim cada dela dele depois dessa desse disse isso mais mesmo muito onde outra outro pela pelo quem seus suas também uma
""".split()))
#: Words of a headline that say nothing about its story.
TITLE_STOPWORDS = tuple("about after from have into just more over said says some than that their them they this were what when will with".split())
PLURALS = ("ies", "es", "s")
MIN_LENGTH = 4


def singular(token: Column) -> Column:
    """Lower case without the first of ``PLURALS`` that leaves at least four letters."""
    return _stem(F.lower(token))


def _stem(token: Column) -> Column:
    out = token
    for suffix in reversed(PLURALS):
        fits = token.endswith(suffix) & (F.length(token) - len(suffix) >= MIN_LENGTH) & (F.length(token) > MIN_LENGTH)
        out = F.when(fits, F.left(token, F.length(token) - len(suffix))).otherwise(out)
    return out


def tokens(text: Column) -> Column:
    """Letter runs of four or more in any script, singular, without stopwords; null text has none."""
    words = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\p{L}{4,})"), F.lit(1)), F.lower)
    words = F.transform(words, _stem)  # lambdas share nothing: each mention of a lower case would be worked out again
    return F.filter(words, lambda w: (F.length(w) >= MIN_LENGTH) & ~w.isin(*STOPWORDS))  # so many literals become a hash set


def token_rows(docs: DataFrame, by: list[str], text: Column) -> DataFrame:
    """``by`` and ``term``, a row for each of ``tokens(text)``: exploded first, so that all that follows is generated code."""
    raw = docs.select(*by, F.explode(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\p{L}{4,})"), F.lit(1))).alias("term"))
    term = F.col("term")
    return raw.select(*by, singular(term).alias("term")).filter((F.length(term) >= MIN_LENGTH) & ~term.isin(*STOPWORDS))


def title_tokens(title: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit(r"([a-z]{4,})"), F.lit(1))
    return F.array_distinct(F.filter(words, lambda w: ~w.isin(*TITLE_STOPWORDS)))


def bigrams(words: Column) -> Column:
    """Adjacent pairs as "a b". Fewer than two words give none."""
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda p: p.isNotNull())


ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&hellip;", "…"), ("&mdash;", "—"), ("&ndash;", "–"), ("&amp;", "&"))


def strip_html(text: Column) -> Column:
    """Tags out, common entities decoded, white space collapsed and trimmed."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", " ")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


#: " - Outlet Name" at the end: a dash or bar, a capital, up to thirty more signs of a name.
OUTLET_SUFFIX = r"\s*[|–—-]" + r"\s*[A-Z]" + r"(?:[/'.&]|\w| ){1,30}" + r"\s*$"


#: Kana, Han, Arabic, Hebrew, Cyrillic, Latin with marks, plain Latin.
KEPT = ("぀-ヿ", "一-鿿", "؀-ۿ", "֐-׿", "Ѐ-ӿ", "À-ɏ", "a-z")


def normalise_title(title: Column) -> Column:
    """Outlet suffix off (twice at most), lower case, quotes out, unknown signs to spaces.

    Only Latin, Cyrillic, Hebrew, Arabic, Han and Kana survive, so that the keys equal those of existing archives.
    """
    text = F.trim(F.coalesce(title, F.lit("")))
    for _ in range(2):
        text = F.regexp_replace(text, "(?U)" + OUTLET_SUFFIX, "")
    text = F.regexp_replace(F.lower(text), "['‘’“”]", "")
    text = F.regexp_replace(text, "[^ " + "0-9" + "".join(KEPT) + "]", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def signal_text(body: Column, summary: Column, title: Column, body_min: int = 500, body_max: int = 2500, summary_min: int = 60) -> Column:
    """struct(level, text): the body if long enough, else title and summary, else the title, else empty."""
    body, summary, title = (F.trim(F.coalesce(c, F.lit(""))) for c in (body, summary, title))
    return (
        F.when(F.length(body) >= body_min, F.struct(F.lit("body").alias("level"), F.trim(F.left(body, F.lit(body_max))).alias("text")))
        .when(F.length(summary) >= summary_min, F.struct(F.lit("summary").alias("level"), F.concat(title, F.lit("\n\n"), summary).alias("text")))
        .when(title != "", F.struct(F.lit("title").alias("level"), title.alias("text")))
        .otherwise(F.struct(F.lit("empty").alias("level"), F.lit("").alias("text")))
    )


def embedding_excerpt(body: Column, summary: Column, title: Column) -> Column:
    body, summary, title = (F.coalesce(c, F.lit("")) for c in (body, summary, title))
    rest = F.when(F.length(body) >= 100, body).when(F.length(summary) >= 60, summary).otherwise(F.lit(""))
    return F.trim(F.concat(F.left(title, F.lit(240)), F.lit("\n"), F.left(rest, F.lit(1500))))


def is_stub(title: Column, summary: Column) -> Column:
    """No summary, or one that repeats the title and adds fewer than 40 characters."""
    title, summary = F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit(""))
    return (summary == "") | (summary.startswith(F.left(title, F.lit(60))) & (F.abs(F.length(summary) - F.length(title)) < 40))


def extraction_class(chars: Column, error: Column) -> Column:
    chars = F.coalesce(chars, F.lit(0))
    return F.when(error.isNotNull(), "ERROR").when(chars >= 1000, "FULL").when(chars >= 200, "PARTIAL").when(chars >= 50, "STUB").otherwise("NONE")


SCRIPTS = (
    ("zh/ja-han", "[一-鿿]"), ("ja-kana", "[぀-ヿ]"), ("ar/fa", "[؀-ۿ]"), ("he", "[֐-׿]"), ("ru-cyrillic", "[Ѐ-ӿ]"),
    ("hi-deva", "[ऀ-ॿ]"), ("ko", "[가-힯]"), ("tr-extlatin", "[ğşıçöü]"), ("pt/es-extlatin", "[áéíóúãâê]"),
)


def script_of(text: Column) -> Column:
    out = F.when(F.coalesce(text, F.lit("")) == "", "empty")
    for name, pattern in SCRIPTS:
        out = out.when(F.lower(text).rlike(pattern), name)
    return out.otherwise("latin")


def truncate(text: Column, n: int) -> Column:
    return F.when(F.length(text) <= n, text).otherwise(F.concat(F.rtrim(F.left(text, F.lit(n - 1))), F.lit("…")))


def short_quote_word(quote: Column, least: int = 4) -> Column:
    """The first word of four letters or more that is no stopword; empty if there is none."""
    return F.coalesce(F.try_element_at(tokens(quote), F.lit(1)), F.lit(""))


def jaccard(a: Column, b: Column, empty: str = "zero") -> Column:
    """Of two arrays as sets. Both empty: ``zero`` 0.0 (lineage), ``null`` NULL (frames, titles)."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0 if empty == "zero" else None).cast("double"))


#: Label -> pattern on the lower-case headline.
FRAMING = {
    "aggression": r"\baggress(or|ive|ion)\b", "ceasefire": r"\b(truce|cease[ -]?fire)\b", "genocide": r"\bgenocid", "imperialist": r"\bimperial", "liberation": r"\bliberat",
    "martyr": r"\bmartyr", "negotiation": r"\bnegotiat", "occupation": r"\boccup(ied|ier|ation)\b", "operation": r"\boperation\b", "proxy": r"\bprox(y|ies)\b",
    "regime": r"\bregime\b", "resistance": r"\bresistance\b", "sanction": r"\bsanction", "terrorist": r"\bterrorists?\b", "war_crime": r"\bwar crim", "zionist": r"\bzionist",
}


def matches(text: Column, patterns: list[str], exclude: list[str] = ()) -> Column:
    """Any pattern, and no excluded one, in the lower-case text."""
    text = F.lower(F.coalesce(text, F.lit("")))
    hit = text.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)
    return hit & ~text.rlike("|".join(f"(?:{p})" for p in exclude)) if exclude else hit
