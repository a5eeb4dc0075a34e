"""String helpers: folding, squeezing, ids, contacts, units, tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sem import col, regexp_extract_n, safe_cast

# Accented letters and the plain letter each one becomes.
ACCENTED = "ŠŽšžŸÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïðñòóôõöùúûüýÿ"
PLAIN = "SZszYAAAAAACEEEEIIIIDNOOOOOUUUUYaaaaaaceeeeiiiidnooooouuuuyy"


def fold_accents(c) -> Column:
    """Replace accented letters by their plain form."""
    return F.translate(col(c), ACCENTED, PLAIN)


def fold_and_strip(c) -> Column:
    """Fold accents, delete ``, ; / . ' "`` and blank every other sign."""
    bare = F.regexp_replace(fold_accents(c), "[,;/.'\"]", "")
    return F.regexp_replace(bare, "[^a-zA-Z0-9]", " ")


def squeeze_blanks(c) -> Column:
    """Collapse runs of white space to one blank."""
    return F.regexp_replace(col(c), r"\s+", " ")


def strip_float_tail(c) -> Column:
    """``'123.0'`` -> ``'123'`` for ids that were once read as numbers."""
    return F.regexp_replace(col(c).cast("string"), r"\.0$", "")


def split_document(c, sep: str = "-") -> tuple[Column, Column]:
    """Split at the first separator into (series, number)."""
    parts = F.split(col(c), sep, 2)
    return F.get(parts, 0), F.get(parts, 1)


def zero_pad(c, width: int) -> Column:
    """Left-pad with zeros; longer values are kept whole."""
    s = col(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def phone_with_prefix(c, prefix: str = "+51") -> Column:
    return F.concat(F.lit(prefix), col(c))


def first_words(c, n: int = 2) -> Column:
    return F.substring_index(col(c), " ", n)


def edit_distance(a, b) -> Column:
    """Case-blind Levenshtein distance; a missing second value counts as equal."""
    a = col(a)
    return F.levenshtein(F.lower(a), F.lower(F.coalesce(col(b), a)))


def needs_fix(condition: Column, bad: str = "Corregir", good: str = "Ok") -> Column:
    """Label a failed comparison; unknown counts as good."""
    return F.when(condition, bad).otherwise(good)


# Shapes of a contact line.
CONTACT_EMAIL = r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"
CONTACT_PHONE = r"(?:^|[^0-9])(9[0-9]{8})(?:[^0-9]|$)"
CONTACT_NAME = r"^\s*([A-Za-zÀ-ÿ]+(?:\s+[A-Za-zÀ-ÿ]+)*)"


def extract_contact(c) -> Column:
    """Struct (name, phone, email) found in free text, NULL where absent."""
    return F.struct(
        regexp_extract_n(c, CONTACT_NAME).alias("name"),
        regexp_extract_n(c, CONTACT_PHONE).alias("phone"),
        regexp_extract_n(c, CONTACT_EMAIL).alias("email"),
    )


def valid_length(c, n: int) -> Column:
    """Keep a value only if it has exactly ``n`` characters."""
    c = col(c)
    return F.when(F.length(c) == n, c)


# Unit spellings in product names, applied in this order.
UNIT_RULES: tuple[tuple[str, str], ...] = (
    (r"[^a-zA-Z0-9. ]", ""),
    (r"\b(ml[a-z]{0,2}\b)|([0-9]{1,2})(m\b)", "$1ml"),
    (r"cc\b|cm3\b| ml\b| mlml\b", "ml"),
    (r"\b(lt[a-z]{0,1}\b)|([0-9]{1,2})(lt[a-z]{0,1}\b)", "$1l"),
    (r"\blitros\b|lt[a-z]{0,1}| litros\b| lt[a-z]{0,1}\b", "l"),
    (r"\b(onz[a-z]{0,1}\b)|([0-9]{1,2})(onz[a-z]{0,1}\b)", "$1oz"),
    (r" oz\b", "oz"),
    (r"\b(kg[a-z]{0,1}\b)|([0-9]{1,2})(kg[a-z]{0,1}\b)", "$1kg"),
    (r"kgkg|kilos|kilogramos| kg\b| kilos\b| kilogramos\b", "kg"),
    (r"\b(gr[a-z]{0,1}\b)|([0-9]{1,2})(gr[a-z]{0,1}\b)", "$1g"),
    (r"pulgadas|pulgada|pulg.|\"| pulgadas", "in"),
    (r"centimetros|cms| centimetros\b| cms\b", "cm"),
    (r"\bmetros\b|\bmetro\b|\bmts\b", "m"),
    (r"television|televiso[a-z]{0,2}|tv", "tv"),
    (r"([0-9]{1,4})\s([cgiklmo]{1}\b)", "$1$2"),
)


def normalise_units(c, rules: Sequence[tuple[str, str]] = UNIT_RULES) -> Column:
    """Lower-case, fold and rewrite unit spellings of a product name."""
    out = F.lower(fold_accents(c))
    for pattern, replacement in rules:
        out = F.regexp_replace(out, pattern, replacement)
    return out


# Words and digits that mark screen sizes, apparel groups, plurals.
TWO_DIGITS = r"(\b\d{2}\b|\b\d{2}|d{2})"
SCREEN_NAMES = r"tv|laptop|monitor|tablet"
SCREEN_CATEGORIES = r"portatiles|notebooks|desktop"
NO_DIGIT_GROUPS = ("G07", "G08", "G18")


def contextual_name(name, category, group) -> Column:
    """Mark screen inches, drop digits of apparel and singularise plurals."""
    name, category, group = col(name), col(category), col(group)
    is_screen = name.rlike(SCREEN_NAMES) | F.coalesce(category.rlike(SCREEN_CATEGORIES), F.lit(False))
    base = (
        F.when(is_screen, F.regexp_replace(name, TWO_DIGITS, "$1in"))
        .when(group.isin(list(NO_DIGIT_GROUPS)), F.regexp_replace(name, r"\d", ""))
        .otherwise(name)
    )
    out = F.regexp_replace(F.trim(base), r"\s{2,}", " ")
    for pattern, replacement in ((r"inin", "in"), (r"\b([a-z]+)as\b", "$1a"), (r"\b([a-z]+)os\b", "$1o")):
        out = F.regexp_replace(out, pattern, replacement)
    return out


# A measured amount inside a product name, and its unit.
AMOUNT = r"(\d{1,3}\.\d{1,3}|(?:\d{1,3})(?:cm|kg|lb|mg|ml|mm|oz|in|g|l|m)\b|\d{2}in)"
UNIT_LETTERS = r"([a-z]{1,2})"


def dimension_quantity(c) -> Column:
    """Number of the first measured amount; 1 when the name has none."""
    amount = regexp_extract_n(c, AMOUNT)
    return F.coalesce(safe_cast(F.regexp_replace(amount, UNIT_LETTERS, ""), "double"), F.lit(1.0))


def dimension_unit(c) -> Column:
    """Unit of the first measured amount; ``un`` when there is none."""
    return F.coalesce(regexp_extract_n(regexp_extract_n(c, AMOUNT), UNIT_LETTERS), F.lit("un"))


def pack_quantity(c) -> Column:
    """Pieces in a pack (``12un``), at least 1."""
    n = safe_cast(regexp_extract_n(c, r"([0-9]{1,4})un"), "int")
    return F.greatest(F.coalesce(n, F.lit(1)), F.lit(1))


def mail_body(c) -> Column:
    """Body of a mail kept in a task text: between the opening and closing words."""
    clean = F.lower(fold_and_strip(c))
    inner = regexp_extract_n(clean, r"(?s)cuerpo\s*(.*)agradecemos")
    flat = squeeze_blanks(inner)
    cut = F.regexp_replace(regexp_extract_n(flat, r"^(.*con esta informacion)"), " con esta informacion", "")
    return F.coalesce(cut, flat)


def task_type(c) -> Column:
    """Kind of a task by the first words of its subject."""
    c = col(c)
    return F.when(c.rlike("^Correo electr"), "Correo").when(c.rlike("^Recontacto"), "Recontacto").otherwise("Task")


def task_text(subject, description) -> Column:
    """Mail tasks give their body, other tasks their cleaned text."""
    plain = squeeze_blanks(F.lower(fold_and_strip(description)))
    return F.when(task_type(subject) == "Correo", mail_body(description)).otherwise(plain)


def tokens(c, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case alphanumeric words without the stop words."""
    words = F.split(F.lower(col(c)), r"[^\p{L}\p{N}]+")
    words = F.filter(words, lambda w: F.length(w) > 0)
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(list(stop_words)))
    return words


def remove_stop_words(c, stop_words: Sequence[str]) -> Column:
    """Drop stop words but keep the other words as written."""
    words = F.split(col(c), r"\s+")
    return F.array_join(F.filter(words, lambda w: (F.length(w) > 0) & ~F.lower(w).isin(list(stop_words))), " ")


def order_url(base: str, order_id, seller_id) -> Column:
    """Address of an order page built from its ids."""
    return F.concat(F.lit(base.rstrip("/") + "/id/"), col(order_id).cast("string"), F.lit("/sellerId/"), col(seller_id).cast("string"))


def label_url(base: str, tracking, min_len: int = 11) -> Column:
    """Address of a label; NULL for codes too short to be a tracking code."""
    t = col(tracking)
    return F.when(F.length(t) >= min_len, F.concat(F.lit(base.rstrip("/") + "/"), t, F.lit(".pdf")))


def tracking_url(templates: dict[str, str], carrier, tracking) -> Column:
    """Address of a parcel by carrier; carriers without a template give NULL."""
    carrier, tracking = col(carrier), col(tracking)
    out = None
    for name, base in templates.items():
        cond = carrier == name
        value = F.concat(F.lit(base), tracking)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return F.lit(None).cast("string") if out is None else out
