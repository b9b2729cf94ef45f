"""Lists, patterns and constants that decide results.

Everything here is data. Each value has to be exactly what it is for results to
be right; the logic that uses it lives in the other modules.
"""

# --- Fixed values: link and page filters -------------------------------------

BLOCKED_DOMAINS = (
    "github.com", "linkedin.com", "xing.com", "instagram.com", "twitter.com",
    "youtube.com", "de.wikipedia.org", "wikipedia.org", "google.com",
    "google.de", "google.co.uk", "pinterest.com", "amazon.com", "cctue.de",
    "spotify.com",
)

PAGE_LANGUAGES = ("en", "en-de", "eng", "en-GB", "en-US", "english")

REQUIRED_KEYWORDS = ("tübingen", "tuebingen", "tubingen", "t%C3%BCbingen")

FILE_SUFFIXES = (
    "pdf", "doc", "docx", "ppt", "pptx", "xls", "xlsx", "csv", "zip", "rar",
    "tar", "gz", "7z", "mp3", "mp4", "avi", "mkv", "mov", "flv", "wav", "ogg",
    "webm", "m4a", "flac", "aac", "wma", "jpg", "jpeg", "png", "gif", "bmp",
    "svg", "webp",
)

# --- Fixed values: HTML --------------------------------------------------------

MAIN_TAGS = ("main", "article", "section", "body")

TEXT_TAGS = (
    "title", "h1", "h2", "h3", "h4", "h5", "h6", "p", "span", "div", "li", "td",
    "th", "a", "b", "strong", "i", "em", "mark", "small", "del", "ins", "sub",
    "sup", "q", "blockquote", "code", "pre",
)

# --- Fixed values: text-cleaning patterns --------------------------------------
# Each is a plain pattern that Java, RE2 and Python read the same way on ASCII.

URL_PATTERN = r"https://\S+|www\.\S+"
TAG_PATTERN = r"<[^>\n]*>"
EMAIL_PATTERN = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9.-]+"
DEGREES_PATTERN = r"\d+\s?°[CFK]"
TIME_PATTERN = (
    r"(?i)\b(?:1[0-2]|0?[1-9]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]{1,3})?)?"
    r"\s*(?:AM|PM|A\.M\.|P\.M\.)?"
    r"|(?:2[0-3]|[01]?[0-9]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]{1,3})?)?\b"
)
PHONE_PATTERN = (
    r"(?:(?:\+\d{1,2}\s?)?1?-?\.?\s?\(?\d{3}\)?[\s.-]?)?\d{3}[\s.-]?\d{4}"
)
EMOJI_PATTERN = (
    "[\U0001F600-\U0001F64F\U0001F300-\U0001F5FF\U0001F680-\U0001F6FF"
    "\U0001F1E0-\U0001F1FF\U00002702-\U000027B0\U000024C2-\U0001F251]+"
)
PRICE_PATTERN = (
    r"(?i)[$€£¥]\s?\d{1,3}(?:,\d{3})*(?:\.\d{1,2})?"
    r"|\d{1,3}(?:,\d{3})*(?:\.\d{1,2})?\s?(?:[$€£¥]|USD|EUR|GBP|JPY)"
)
PERCENT_PATTERN = r"\d+%"
SPECIAL_PATTERN = r"[^\w\s]"
SINGLE_PATTERN = r"\b\w\b"

# Dates, month first. {sep} stands for one separator, the same in both places.
DATE_SEPARATORS = ("/", "-", r"\.")
DATE_YEAR = r"(?:1[6-9]|[2-9]\d)?\d{2}"
DATE_LEAP_YEAR = (
    r"(?:(?:1[6-9]|[2-9]\d)?(?:0[48]|[2468][048]|[13579][26])"
    r"|(?:16|[2468][048]|[3579][26])00)"
)
DATE_SHAPES = (
    r"(?:0?[13578]|1[02]){sep}31{sep}{year}",
    r"(?:0?[1,3-9]|1[0-2]){sep}(?:29|30){sep}{year}",
    r"0?2{sep}29{sep}{leap_year}",
    r"(?:0?[1-9]|1[0-2]){sep}(?:0?[1-9]|1\d|2[0-8]){sep}{year}",
)

# --- Fixed values: ASCII spellings of symbols that do not decompose -------------
# Published transliterations of Latin letters and common punctuation.

LETTER_SPELLINGS = {
    "ß": "ss", "ẞ": "SS", "Æ": "AE", "æ": "ae", "Ǽ": "AE", "ǽ": "ae", "Œ": "OE",
    "œ": "oe", "Ø": "O", "ø": "o", "Ǿ": "O", "ǿ": "o", "Đ": "D", "đ": "d",
    "Ð": "D", "ð": "d", "Þ": "Th", "þ": "th", "Ħ": "H", "ħ": "h", "ı": "i",
    "ĸ": "k", "Ł": "L", "ł": "l", "Ŋ": "NG", "ŋ": "ng", "Ŧ": "T", "ŧ": "t",
    "ŉ": "'n",
}
SYMBOL_SPELLINGS = {
    "\u00a0": " ", "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=",
    "¦": "|", "§": "SS", "¨": '"', "©": "(c)", "ª": "a", "«": "<<", "¬": "!",
    "\u00ad": "", "®": "(r)", "¯": "-", "°": "deg", "±": "+-", "²": "2",
    "³": "3", "´": "'", "µ": "u", "¶": "P", "·": "*", "¸": ",", "¹": "1",
    "º": "o", "»": ">>", "¼": "1/4", "½": "1/2", "¾": "3/4", "¿": "?",
    "×": "x", "÷": "/", "‐": "-", "‑": "-", "‒": "-",
    "–": "-", "—": "--", "―": "--", "‘": "'",
    "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"',
    "„": ",,", "‟": '"', "†": "+", "‡": "++", "•": "*",
    "…": "...", "‰": "%0", "′": "'", "″": "''",
    "‹": "<", "›": ">", "⁄": "/", "€": "EUR", "№": "No",
    "™": "tm", "−": "-",
}

# --- Fixed values: ASCII spellings of other alphabets ----------------------------
# Published transliterations, letter by letter. Small letters; capitals are spelled
# alike, and letters with further marks as without them.

GREEK_SPELLINGS = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e",
    "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x",
    "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t", "υ": "u",
    "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}
CYRILLIC_SPELLINGS = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh",
    "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n",
    "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
    "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "'",
    "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia", "ѐ": "ie", "ё": "io",
    "ђ": "dj", "ѓ": "gj", "є": "ie", "ѕ": "dz", "і": "i", "ї": "yi", "ј": "j",
    "љ": "lj", "њ": "nj", "ћ": "tsh", "ќ": "kj", "ѝ": "i", "ў": "u",
    "џ": "dzh", "ґ": "g'",
}

# Kana are spelled as their Unicode names say, but for these.
KANA_SPELLINGS = {"si": "shi", "ti": "chi", "tu": "tsu"}

# Short names of the letters that make up Hangul syllables, from the Unicode standard.
HANGUL_LEADS = ("g", "gg", "n", "d", "dd", "r", "m", "b", "bb", "s", "ss", "", "j", "jj", "c", "k", "t", "p", "h")
HANGUL_VOWELS = (
    "a", "ae", "ya", "yae", "eo", "e", "yeo", "ye", "o", "wa", "wae", "oe", "yo",
    "u", "weo", "we", "wi", "yu", "eu", "yi", "i",
)
HANGUL_TAILS = (
    "", "g", "gg", "gs", "n", "nj", "nh", "d", "l", "lg", "lm", "lb", "ls", "lt",
    "lp", "lh", "m", "b", "bs", "s", "ss", "ng", "j", "c", "k", "t", "p", "h",
)

# --- Fixed values: tokens --------------------------------------------------------
# Common English stop words without the apostrophe forms, which cannot occur
# once special characters have become blanks.

STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he
    him his himself she her hers herself it its itself they them their theirs
    themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under
    again further then once here there when where why how all any both each few
    more most other some such no nor not only own same so than too very s t can
    will just don should now cannot could ought would
    """.split()
)

# Frequent words by which a text's language is told.

LANGUAGE_PROFILES = {
    "en": tuple("the of and to in is that it for was on with as be by are this from at or".split()),
    "de": tuple("der die und das ist nicht ein eine den mit von zu auf sich auch im dem des für sie".split()),
    "fr": tuple("le la les de des et un une du est que qui dans pour pas sur au avec par elle".split()),
    "es": tuple("el la los las de y que en un una por con para es del se no como al su".split()),
    "it": tuple("il lo la gli di e che un una per con non sono della nel del alla si come più".split()),
    "nl": tuple("de het een en van ik te dat die in is niet zijn op aan met voor er maar ook".split()),
    "pt": tuple("o os as de e que em um uma para com não do da dos na no por mais se".split()),
}

# --- Fixed values: messages --------------------------------------------------------

DEFAULT_SUMMARY = "no summary"
NO_TEXT_MESSAGE = "No text provided for summarization."
SHORT_TEXT_MESSAGE = "Insufficient content for summarization."
