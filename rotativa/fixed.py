"""Fixed values.

These constants decide what the results are, so they are stated as they are
required and kept together.  Everything that is a choice of this library is a
parameter of the function that uses it.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: news sites -------------------------------------------------


@dataclass(frozen=True)
class Site:
    """One news site: its name, link domain, base address and unwanted link words."""

    name: str
    domain: str
    base_url: str
    denied_words: tuple[str, ...] = ()


EL_TIEMPO = Site("eltiempo", "eltiempo.com", "https://www.eltiempo.com")
EL_ESPECTADOR = Site(
    "elespectador",
    "elespectador.com",
    "https://www.elespectador.com",
    ("play", "autores", "terminos", "newsletter"),
)
SITES = (EL_TIEMPO, EL_ESPECTADOR)  # the first match wins
UNKNOWN_SOURCE = "unknown"

# --- fixed values: page markup ------------------------------------------------

STRICT_ARTICLE_CLASS = "c-articulo"
STRICT_TITLE_CLASS = "c-articulo__titulo"
STRICT_LINK_CLASS = "c-articulo__titulo__txt"
CARD_CLASS = "Card"
CARD_TITLE_CLASS = "Card-Title"
CARD_SECTION_CLASS = "Card-Section"
GENERIC_BLOCK_CLASSES = ("article", "news", "story")
GENERIC_TITLE_CLASSES = ("title", "headline")
GENERIC_CATEGORY_CLASSES = ("category", "section")

# --- fixed values: headline rules ---------------------------------------------

MIN_TITLE_LENGTH = 10  # a title must be longer than this
DENIED_TITLE_PREFIXES = ("buscar", "seguir", "compartir")
NO_CATEGORY = "Sin categoría"
DEFAULT_CATEGORY = "General"

# --- fixed values: columns ----------------------------------------------------

CSV_COLUMNS = ("fecha", "categoria", "titular", "enlace")
PARTITION_COLUMNS = ("periodico", "year", "month", "day")
REQUIRED_COLUMNS = ("categoria", "titular", "enlace", "fecha", "periodico")
REQUIRED_ITEM_FIELDS = ("categoria", "titular", "enlace")
UNIQUE_TITLE_CHARACTERS = 500
SHORT_TITLE_CHARACTERS = 100
RECENT_DAYS = 7
RETENTION_DAYS = 30

# --- fixed values: text and classifier ----------------------------------------

UNWANTED_CHARACTERS = "[^a-zA-ZáéíóúñÁÉÍÓÚÑ ]"
WANTED_CHARACTER = "[a-zA-ZáéíóúñÁÉÍÓÚÑ ]"
UNWANTED_CHARACTERS_LOWER = r"[^a-záéíóúñ\s]"
NUM_FEATURES = 10000
MAX_ITERATIONS = 10

# --- fixed values: tags whose text counts as a title, tags without content, tags whose text is not shown ---
TITLE_TAGS = ("a", "h1", "h2", "h3", "h4")
EMPTY_TAGS = (
    "area",
    "base",
    "basefont",
    "bgsound",
    "br",
    "col",
    "command",
    "embed",
    "frame",
    "hr",
    "image",
    "img",
    "input",
    "isindex",
    "keygen",
    "link",
    "menuitem",
    "meta",
    "nextid",
    "param",
    "source",
    "spacer",
    "track",
    "wbr",
)
SILENT_TAGS = ("script", "style", "template", "rt", "rp")
