"""Fixed values.

Outputs depend on these strings, patterns and numbers, so they are stated
plainly here and nowhere else.
"""

# --- Fixed values: artefacts replaced during cleaning ------------------------
# characters with a one-character replacement, in order
ARTEFACT_CHARS = "\u2018\u2019\u201c\u201d\u2013\u00a0"
ARTEFACT_CHARS_TO = "''\"\"- "
# characters that are removed
ARTEFACT_REMOVED = "\u200b\ufeff"
EM_DASH, EM_DASH_TO = "\u2014", "--"

# --- Fixed values: boilerplate patterns, any of which drops a line -----------
# a search needs no "anything" at the end of a pattern: what follows a match
# does not change whether there is one
BOILERPLATE_PATTERNS = (
    r"accept(ing)? (all )?cookies",
    r"subscribe to (our )?newsletter",
    r"sign up for (our )?(free )?newsletter",
    r"©\s*\d{4}.*all rights reserved",
    r"privacy policy\s*[|·]\s*terms",
    r"share (this )?(article|post|page)",
    r"follow us on",
    r"advertisement",
    r"skip to (main )?(content|navigation)",
    r"read (also|more)[:\-]",
)

# --- Fixed values: chunking ---------------------------------------------------
TOKENS_PER_WORD = 1.33
DEFAULT_MAX_TOKENS = 800
PREVIEW_CHARS = 200
FLAT_PREVIEW_CHARS = 300

# --- Fixed values: tags whose content is not part of a page's main text ------
NOISE_TAGS = (
    "script", "style", "noscript", "nav", "footer",
    "header", "aside", "form", "iframe", "svg",
)
MAIN_REGIONS = ("article", "main", "body")

# --- Fixed values: retry policies ----------------------------------------------
FETCH_ATTEMPTS = 3
FETCH_TIMEOUT_SECONDS = 15
USER_AGENT = "docsheaf/1.0"
MODEL_ATTEMPTS = 4
MODEL_MIN_WAIT_SECONDS = 2
MODEL_MAX_WAIT_SECONDS = 30
MODEL_TIMEOUT_SECONDS = 45
MODEL_TEMPERATURE = 0.1

# --- Fixed values: providers, their key and model variables, default model ---
PROVIDER_VARIABLE = "LLM_PROVIDER"
DEFAULT_PROVIDER = "openai"
PROVIDERS = {
    "openai": ("OPENAI_API_KEY", "OPENAI_MODEL", "gpt-4o-mini"),
    "groq": ("GROQ_API_KEY", "GROQ_MODEL", "llama-3.3-70b-versatile"),
    "gemini": ("GEMINI_API_KEY", "GEMINI_MODEL", "gemini-1.5-flash"),
}

# --- Fixed values: prompt markers ------------------------------------------------
TEXT_START_MARKER = "--- TEXT TO ANALYSE ---"
TEXT_END_MARKER = "--- END TEXT ---"

# --- Fixed values: defaults in a coerced reply -----------------------------------
LABELS = ("positive", "neutral", "negative")
DEFAULT_LABEL = "neutral"
DEFAULT_CONFIDENCE = 0.5
DEFAULT_SUMMARY = "No summary available."
QUESTION_COUNT = 3
QUESTION_PAD = "No additional question generated."
FALLBACK_SUMMARY = "Extraction failed — raw output could not be parsed as JSON."
FALLBACK_QUESTION = "Could not extract questions."
FALLBACK_CONFIDENCE = 0.0

# --- Fixed values: report layout -------------------------------------------------
BANNER_WIDTH = 70
RULE_WIDTH = 40
TOP_ENTITIES = 5
GENERATED_LINE = "  Generated: "
OVERVIEW_HEADING = "OVERVIEW"
OVERVIEW_LINES = (
    ("documents", "  Total documents ingested : "),
    ("chunks", "  Total chunks processed   : "),
    ("succeeded", "  Successful extractions   : "),
    ("failed", "  Failed / skipped chunks  : "),
)
SOURCES_HEADING = "SOURCES"
SOURCE_LINE = "  • %s  (%s chunk(s))"
SENTIMENT_HEADING = "SENTIMENT DISTRIBUTION"
SENTIMENT_LINES = (
    ("positive", "  Positive : "),
    ("neutral", "  Neutral  : "),
    ("negative", "  Negative : "),
)
CONFIDENCE_LINE = "  Average sentiment confidence: "
ENTITIES_HEADING = "TOP ENTITIES"
ENTITY_HEADINGS = (
    ("people", "  People:"),
    ("places", "  Places:"),
    ("organizations", "  Organizations:"),
)
ENTITY_LINE = "    - %s (%sx)"
NO_ENTITY_LINE = "    (none found)"
CHUNKS_HEADING = "CHUNK SUMMARIES"
CHUNK_LINE = "  [Chunk %s]  %s  (part %s)"
CHUNK_SENTIMENT_LINE = "  Sentiment : %s (conf: %s)"
CHUNK_SUMMARY_LINE = "  Summary   : "
QUESTIONS_LINE, QUESTION_LINE = "  Key Questions:", "    ? "
FAILED_HEADING = "FAILED / SKIPPED CHUNKS"
FAILED_LINE = "  - Source: %s  Part %s/%s"
CLOSING_LINE = "END OF REPORT"

# The instructions sent with every chunk. The wording is ours; the keys, the
# label set, the confidence range and the number of questions are fixed.
REPLY_CONTRACT = """\
Answer with one JSON object and nothing else: no code fence, no text around it.
The object has exactly these keys:

{
  "summary": "a summary of the text in 2-3 sentences",
  "entities": {
    "people": ["names of people"],
    "places": ["names of places"],
    "organizations": ["names of organizations"]
  },
  "sentiment": {"label": "positive, neutral or negative", "confidence": 0.0},
  "key_questions": ["first question", "second question", "third question"]
}

Any entity list may be empty. The label is one of positive, neutral, negative.
The confidence is a number from 0.0 to 1.0. There are exactly 3 key questions.
"""
SYSTEM_MESSAGE = "You extract information from text with precision."
