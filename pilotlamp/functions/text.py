"""Text normalisers, token sets, vocabulary lookups and parsers as Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pilotlamp import vocab
from pilotlamp.functions.arrays import let

CJK = "\\u4e00-\\u9fff"


def _chain(pairs: list[tuple[Column, Column]], default: Column) -> Column:
    """CASE WHEN over the pairs, first true condition wins."""
    if not pairs:
        return default
    first, rest = pairs[0], pairs[1:]
    return reduce(lambda acc, p: acc.when(p[0], p[1]), rest, F.when(first[0], first[1])).otherwise(default)


def _contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def strip(s: Column) -> Column:
    """Trim all Unicode white space at both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(F.regexp_replace(s, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def clean_text(s: Column) -> Column:
    """NULL becomes '', every run of white space one space."""
    return strip(F.regexp_replace(F.coalesce(s.cast("string"), F.lit("")), r"(?U)\s+", " "))


def clean_cell(s: Column) -> Column:
    """Table cell text: spaces and tabs collapse, line breaks stay as single breaks."""
    out = F.translate(F.coalesce(s.cast("string"), F.lit("")), "\u00a0\u3000\r", "  \n")
    return strip(F.regexp_replace(F.regexp_replace(out, "[ \t]+", " "), "\n+", "\n"))


def clean_document(s: Column) -> Column:
    """Document text: spaces and tabs collapse, at most two line breaks in a row."""
    out = F.translate(F.coalesce(s.cast("string"), F.lit("")), "\u00a0\u3000\r", "  \n")
    return strip(F.regexp_replace(F.regexp_replace(out, "[ \t]+", " "), "\n{3,}", "\n\n"))


def compact_key(s: Column) -> Column:
    """Lookup key of a name: no spaces, underscores, dashes, slashes or brackets; lower case."""
    return F.lower(F.regexp_replace(clean_text(s), r"(?U)[\s_\-—–/（）()\[\]【】]+", ""))


def compact_cell(s: Column) -> Column:
    return F.regexp_replace(clean_cell(s), r"(?U)\s+", "")


def alnum_key(s: Column) -> Column:
    """Directory key: ASCII letters, digits and CJK only; lower case."""
    return F.lower(F.regexp_replace(s, f"[^0-9a-zA-Z{CJK}]+", ""))


_FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "\u3000"
_HALF_WIDTH = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "


def half_width(s: Column) -> Column:
    """Full-width ASCII to ASCII: the part of NFKC that equipment names need, without Python."""
    return F.translate(s, _FULL_WIDTH, _HALF_WIDTH)


def label_key(s: Column) -> Column:
    """Key of a short printed label."""
    return F.regexp_replace(F.upper(half_width(s)), r"(?U)[\s_\-./\\()（）【】\[\]:：]+", "")


def catalog_key(s: Column) -> Column:
    """Key of an indicator name in the catalogue."""
    return F.regexp_replace(F.upper(half_width(s)), r"(?U)[\s_\-./\\:：,，;；()（）\[\]【】]+", "")


def letters_key(s: Column) -> Column:
    """Letters, digits and CJK of any script; lower case."""
    return F.regexp_replace(F.lower(half_width(s)), r"[^\p{L}\p{N}]+", "")


def plain_name(s: Column) -> Column:
    """Comparable name: lower case, dashes and slashes unified, noise nouns dropped."""
    out = F.translate(F.lower(clean_text(s)), "（）－—–_/\\", "()---   ")
    for noun in vocab.NOISE_NOUNS:
        out = F.replace(out, F.lit(noun), F.lit(" "))
    out = F.regexp_replace(out, f"[^0-9a-z{CJK}]+", " ")
    return F.trim(out)


def solid_name(s: Column) -> Column:
    return F.regexp_replace(plain_name(s), f"[^0-9a-z{CJK}]", "")


def name_tokens(s: Column) -> Column:
    """Words, model numbers and ASCII runs of three or more characters of a plain name."""
    n = plain_name(s)
    words = F.filter(F.split(n, " "), lambda x: x != "")
    models = F.transform(F.regexp_extract_all(n, F.lit(r"([a-z]+\s*[-_]?\s*\d+[a-z0-9-]*)"), F.lit(1)),
                         lambda x: F.regexp_replace(x, r"\s+", ""))
    runs = F.regexp_extract_all(n, F.lit("([a-z0-9-]{3,})"), F.lit(1))
    return F.array_sort(F.array_distinct(F.concat(words, models, runs)))


def is_model_token(t: Column) -> Column:
    return t.rlike("[a-z]") & t.rlike("[0-9]")


def keyword_tokens(s: Column) -> Column:
    """Lower-case parts of a directory name between separators."""
    parts = F.split(F.lower(half_width(s)), r"(?U)[\s_\-./\\()\[\]（）【】,，:：;；]+")
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def print_key(s: Column) -> Column:
    """Upper-case text of a print or manual, without white space and unusual marks."""
    out = F.replace(F.upper(F.coalesce(s, F.lit(""))), F.lit("／"), F.lit("/"))
    return F.regexp_replace(F.regexp_replace(out, r"(?U)\s+", ""), "[^A-Z0-9+\\-/一-龥]", "")


def print_tokens(s: Column) -> Column:
    """Tokens of a print: upper-case ASCII words, CJK runs of 2-8 and the whole text."""
    raw = F.coalesce(s, F.lit(""))
    ascii_words = F.regexp_extract_all(F.upper(raw), F.lit("([A-Z][A-Z0-9/+_-]{1,24})"), F.lit(1))
    cjk_runs = F.regexp_extract_all(raw, F.lit(f"([{CJK}]{{2,8}})"), F.lit(1))
    tokens = F.transform(F.concat(ascii_words, cjk_runs, F.array(raw)), print_key)
    return F.array_distinct(F.filter(tokens, lambda x: x != ""))


def alias_names(name: Column) -> Column:
    """Other spellings of a device name, sorted, without the name itself."""
    raw = clean_text(name)
    bare = F.trim(F.regexp_replace(raw, r"（.*?）|\(.*?\)", ""))
    latin = F.filter(F.transform(F.regexp_extract_all(raw, F.lit(r"((?:[A-Za-z]+(?:[- ]?[A-Za-z0-9]+)*\s*)+)"), F.lit(1)),
                                 clean_text), lambda x: F.length(x) >= 3)
    models = F.transform(F.regexp_extract_all(raw, F.lit(r"([A-Za-z]{1,10}[- ]?\d+[A-Za-z0-9-]*)"), F.lit(1)),
                         lambda x: F.replace(x, F.lit(" "), F.lit("")))
    pieces = F.filter(F.split(raw, r"(?U)[\s（）()、,/]+"), lambda x: F.length(x) >= 3)
    every = F.array_distinct(F.concat(F.array(bare), latin, models, pieces))
    return F.array_sort(F.filter(every, lambda x: (x != "") & (x != raw)))


def _lookup(raw: Column, table: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(v) for kv in table.items() for v in kv])
    return F.coalesce(F.element_at(pairs, raw), F.element_at(pairs, F.lower(raw)))


def _first_contained(raw: Column, table: dict[str, str], default: Column) -> Column:
    return _chain([(raw.contains(k), F.lit(v)) for k, v in table.items()], default)


def request_color(s: Column) -> Column:
    def read(raw: Column) -> Column:
        fallback = F.when(raw == "", "unknown").otherwise(F.lower(raw))
        return F.coalesce(_lookup(raw, vocab.REQUEST_COLORS), _first_contained(raw, vocab.REQUEST_COLORS, fallback))

    return let(clean_text(s), read)


def request_state(s: Column) -> Column:
    def read(raw: Column) -> Column:
        fallback = F.when(raw == "", "unknown").otherwise(F.lower(raw))
        either = F.when(raw.contains("常亮") & raw.contains("闪烁"), "steady_or_blinking")
        return F.coalesce(_lookup(raw, vocab.REQUEST_STATES), either,
                          _first_contained(raw, vocab.REQUEST_STATES, fallback))

    return let(clean_text(s), read)


def rule_color(s: Column) -> Column:
    """Exact word, else all distinct contained colours joined by '_'."""
    pairs = F.create_map(*[F.lit(v) for kv in vocab.RULE_COLORS.items() for v in kv])

    def read(text: Column) -> Column:
        hits = F.array(*[F.when(text.contains(k), v) for k, v in vocab.RULE_COLORS.items()])
        found = F.array_join(F.array_distinct(F.filter(hits, lambda x: x.isNotNull())), "_")
        return F.coalesce(F.element_at(pairs, text), F.nullif(found, F.lit("")), F.lit("unknown"))

    return let(compact_cell(s), read)


def rule_state(s: Column) -> Column:
    """Exact word, else the longest contained word."""
    by_length = dict(sorted(vocab.RULE_STATES.items(), key=lambda kv: -len(kv[0])))
    pairs = F.create_map(*[F.lit(v) for kv in vocab.RULE_STATES.items() for v in kv])
    return let(compact_cell(s), lambda text: F.coalesce(
        F.element_at(pairs, text), _first_contained(text, by_length, F.lit("unknown"))))


def severity_of(meaning: Column, state: Column, longest_match: bool = False) -> Column:
    """Severity of a rule text.

    Word lists are tested critical, warning, normal, info. ``无告警`` switches the critical list off.
    ``longest_match`` picks the longest contained word of all lists instead.
    """
    lists = [("critical", vocab.CRITICAL_WORDS), ("warning", vocab.WARNING_WORDS), ("normal", vocab.NORMAL_WORDS),
             ("info", vocab.INFO_WORDS)]
    lists = [(sev, [w.replace(" ", "").lower() for w in words]) for sev, words in lists]

    def read(text: Column) -> Column:
        tail = _chain([
            (text.contains(vocab.NO_ALARM), F.lit("normal")),
            ((state == "off") & _contains_any(text, vocab.OFF_CRITICAL_WORDS), F.lit("critical")),
        ], F.lit("unknown"))
        if longest_match:
            order = sorted(((w, sev) for sev, words in lists for w in words), key=lambda p: -len(p[0]))
            return _chain([(text.contains(w), F.lit(sev)) for w, sev in order], tail)
        pairs = []
        for sev, words in lists:
            hit = _contains_any(text, words)
            pairs.append((hit & ~text.contains(vocab.NO_ALARM) if sev == "critical" else hit, F.lit(sev)))
        return _chain(pairs, tail)

    return let(F.lower(compact_cell(meaning)), read)


def severity_rank(s: Column) -> Column:
    return _chain([(s == k, F.lit(v)) for k, v in vocab.SEVERITY_RANK.items()], F.lit(-1))


def parse_observation(s: Column) -> Column:
    """``indicator=color,state`` (either comma) to a struct; NULL without '='."""
    parts = F.split(s, "=", 2)
    values = F.filter(F.transform(F.split(F.get(parts, F.lit(1)), "[,，]"), clean_text), lambda x: x != "")
    unknown = F.lit("unknown")
    two = F.size(values) >= 2
    color = F.when(two, F.get(values, F.lit(0))).otherwise(unknown)
    state = F.when(two, F.get(values, F.lit(1))).otherwise(F.coalesce(F.get(values, F.lit(0)), unknown))
    return F.when(s.contains("="), F.struct(
        clean_text(F.get(parts, F.lit(0))).alias("indicator"),
        request_color(color).alias("color"), request_state(state).alias("state")))


def split_values(s: Column) -> Column:
    return F.filter(F.transform(F.split(clean_cell(s), "[；;]+"), strip), lambda x: x != "")


def bare_json(s: Column) -> Column:
    """Model output without thinking blocks and code fences."""
    out = strip(F.regexp_replace(F.coalesce(s, F.lit("")), r"(?is)<think>.*?</think>", ""))
    out = F.regexp_replace(F.regexp_replace(out, r"(?i)^```json\s*", ""), r"^```\s*", "")
    return strip(F.regexp_replace(out, r"\s*```$", ""))


def json_object(s: Column) -> Column:
    """The JSON object in free text: the whole text if it parses, else first '{' to last '}'."""
    def valid(text: Column) -> Column:  # plain prose is told by its first letters; a failing parse is slow
        return F.when(text.rlike(r'^(?:[\[{"0-9-]|true|false|null)') & F.try_parse_json(text).isNotNull(), text)

    return let(bare_json(s), lambda bare: F.coalesce(valid(bare), let(F.regexp_extract(bare, r"(?s)\{.*\}", 0), valid)))


def json_array(s: Column) -> Column:
    """The JSON array in free text; a single object becomes an array of one."""
    def valid(text: Column) -> Column:
        return F.when((text != "") & F.try_parse_json(text).isNotNull(), text)

    fenced = F.regexp_extract(F.coalesce(s, F.lit("")), r"(?is)```(?:json)?\s*(.*?)```", 1)
    bare = let(fenced, lambda inside: F.when(inside != "", strip(inside)).otherwise(bare_json(s)))
    return let(bare, lambda text: F.coalesce(
        let(F.regexp_extract(text, r"(?s)\[.*\]", 0), valid),
        F.concat(F.lit("["), let(F.regexp_extract(text, r"(?s)\{.*\}", 0), valid), F.lit("]"))))


def semantic_key(name: Column, short_label: Column) -> Column:
    """Semantic family of an indicator, else ``RAW:`` and the catalogue key."""
    text = F.upper(F.concat_ws(" ", F.coalesce(short_label, F.lit("")), F.coalesce(name, F.lit(""))))
    pairs = [(reduce(lambda a, b: a | b, [text.rlike("(?i)" + p) for p in patterns]), F.lit(key))
             for key, patterns in vocab.SEMANTIC_PATTERNS]
    return _chain(pairs, F.concat(F.lit("RAW:"), catalog_key(F.coalesce(name, F.lit("")))))


def preferred_name(key: Column) -> Column:
    return _chain([(key == k, F.lit(v)) for k, v in vocab.PREFERRED_NAMES.items()], F.lit(None).cast("string"))


def short_label_of(name: Column, short_label: Column) -> Column:
    """Given short label, else the first upper-case word of the name."""
    given = F.trim(F.coalesce(short_label, F.lit("")))
    word = F.regexp_extract(F.upper(F.coalesce(name, F.lit(""))), r"\b([A-Z][A-Z0-9/+-]{1,20})\b", 1)
    return label_key(F.when(given != "", given).otherwise(word))


def is_state_only(name: Column) -> Column:
    """True for names that state a colour or a behaviour but no light."""
    text = F.trim(F.coalesce(name, F.lit("")))
    return ((text == "") | text.rlike(vocab.STATE_ONLY_PATTERN)
            | (_contains_any(text, vocab.STATE_WORDS) & ~_contains_any(F.upper(text), vocab.TARGET_WORDS)))


def safe_name(s: Column) -> Column:
    """File-safe device name."""
    out = F.regexp_replace(F.regexp_replace(F.trim(s), r'[\\/:*?"<>|\r\n\t]+', "_"), r"(?U)\s+", "_")
    out = F.regexp_replace(F.regexp_replace(out, "_+", "_"), r"^[._]+|[._]+$", "")
    return F.coalesce(F.when(out != "", out), F.lit("unknown_device"))


def class_name(s: Column) -> Column:
    return F.regexp_replace(F.translate(strip(s), "/\\", "__"), r"(?U)\s+", "_")


def canonical_id(s: Column) -> Column:
    """ASCII slug and a short hash, so that names that differ only in CJK stay apart."""
    slug = F.regexp_replace(F.regexp_replace(plain_name(s), "[^0-9a-z]+", "_"), "^_+|_+$", "")
    return F.concat_ws("_", F.when(slug != "", slug).otherwise("device"), F.substring(F.sha1(s), 1, 8))


def video_group(filename: Column) -> Column:
    """Split group of an annotated image: second ``video_N`` part, else the first, else the photo itself."""
    parts = F.filter(F.split(filename, "__"), lambda p: p.rlike(r"^video_\d+$"))
    video = F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))
    return F.when(filename.startswith("video_") & video.isNotNull(), F.concat(F.lit("video::"), video)).otherwise(
        F.concat(F.lit("photo::"), filename))


def track_group(filename: Column) -> Column:
    """Group in which boxes are followed over time; all photos form one group."""
    video = F.lower(F.regexp_extract(filename, r"(?i)__(video_\d+)__", 1))
    return F.when(video != "", video).when(filename.rlike(r"(?i)^photo_\d+"), "__photos__")


def clip_group(stem: Column, parent: Column) -> Column:
    """Group of an extracted frame: text up to ``__video_N``, else the directory."""
    prefix = F.regexp_extract(stem, r"^(.+?__video_\d+)", 1)
    return F.coalesce(F.when(prefix != "", prefix), F.when(parent != "", parent), stem)


def frame_time(filename: Column) -> Column:
    t = F.regexp_extract(filename, r"(?i)__t(\d+(?:\.\d+)?)__", 1)
    f = F.regexp_extract(filename, r"(?i)__f(\d+)__", 1)
    return F.coalesce(F.when(t != "", t).cast("double"), F.when(f != "", f).cast("double"), F.lit(0.0))


def natural_key(filename: Column) -> Column:
    """Sort key: photos first, then text with numbers compared by value, of any length.

    A number is written as the count of its digits, without leading zeros, and the digits; equal values of unequal
    length are told apart by their zeros at the end of the key.
    """
    lower = F.lower(filename)
    stem = F.regexp_replace(lower, r"\.[^.]*$", "")
    suffix = F.regexp_extract(lower, r"(\.[^.]*)$", 1)
    parts = F.regexp_extract_all(stem, F.lit(r"(\d+|\D+)"), F.lit(1))

    def number(p: Column) -> Column:
        value = F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.concat(F.format_string("%08d", F.length(value)), value)

    keyed = F.transform(parts, lambda p: F.when(p.rlike("^[0-9]"), number(p)).otherwise(p))
    zeros = F.array_join(F.transform(F.filter(parts, lambda p: p.rlike("^[0-9]")), lambda p: F.length(p).cast("string")), ",")
    return F.concat(F.when(stem.startswith("photo"), "0").otherwise("1"), F.array_join(keyed, ""), F.lit("|"), suffix, F.lit("|"), zeros)


def clock_text(seconds: Column) -> Column:
    whole = F.floor(F.greatest(seconds, F.lit(0))).cast("long")
    return F.format_string("%02d:%02d", F.floor(whole / 60).cast("long"), whole % 60)


def content_id(*parts: Column) -> Column:
    return F.sha1(F.concat_ws("||", *[p.cast("string") for p in parts]))
