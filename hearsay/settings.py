"""Run parameters and the fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

FALLBACK_CATEGORY = "other"

# Source name, permalink prefix and run limits.
DEFAULT_SOURCE = "hackernews_algolia"
PERMALINK_PREFIX = "https://news.ycombinator.com/item?id="
HITS_PER_PAGE = 50
POSITIVE_THRESHOLD = 0.05
NEGATIVE_THRESHOLD = -0.05
SAMPLE_SIZE = 25
SAMPLE_SEED = 42
TOP_ITEMS_PER_TOPIC = 3

# Lengths, in characters, at which stored or shown text is cut.
EXCERPT_CHARS = 90
LABEL_CHARS = 110
RUN_TIME_CHARS = 19

# Ordered category rules. The first pattern that matches, in this
# order, gives the category. Searches ignore case.
CATEGORY_RULES: list[tuple[str, list[str]]] = [
    ("product_launch", [
        r"\blaunch(?:e[sd]|ing)?\b",
        r"\brelease[sd]?\b",
        r"\breleasing\b",
        r"\bannounc(?:e[sd]?|ing|ement)\b",
        r"\bintroduc(?:e[sd]?|ing)\b",
        r"\bnow available\b",
        r"\bgeneral availability\b",
        r"\bunveil(?:s|ed)?\b",
        r"\bship(?:s|ped|ping)\b",
        r"\bnew (?:model|version|feature|app)\b",
        r"\bv?\d+\.\d+\b",
        r"\bbeta\b",
        r"\bpreview\b",
        r"\bupdate[sd]?\b",
    ]),
    ("business_news", [
        r"\bfunding\b",
        r"\braise[sd]?\b",
        r"\bvaluation\b",
        r"\bipo\b",
        r"\bacqui(?:re[sd]?|sition)\b",
        r"\bmerger\b",
        r"\brevenue\b",
        r"\bearnings\b",
        r"\bprofit(?:s|able)?\b",
        r"\blayoffs?\b",
        r"\bhiring\b",
        r"\bceo\b",
        r"\bpartnership\b",
        r"\bdeal\b",
        r"\bmarket share\b",
        r"\bbillion\b",
        r"\bmillion\b",
        r"\bstartup\b",
        r"\bsubscription\b",
        r"\bpricing\b",
        r"\bprice hike\b",
    ]),
    ("criticism", [
        r"\bproblem[s]?\b",
        r"\bissue[s]?\b",
        r"\bbug[s]?\b",
        r"\bbroken\b",
        r"\bfail(?:s|ed|ure|ing)?\b",
        r"\bworse\b",
        r"\bworst\b",
        r"\bdisappoint(?:ed|ing|ment)?\b",
        r"\bcomplain(?:t|ts|ing)?\b",
        r"\bconcern(?:s|ed)?\b",
        r"\bprivacy\b",
        r"\blawsuit\b",
        r"\bsued?\b",
        r"\bban(?:s|ned|ning)?\b",
        r"\bcontrovers(?:y|ial)\b",
        r"\bscandal\b",
        r"\bhallucinat(?:e[sd]?|ion|ions|ing)\b",
        r"\bmisinformation\b",
        r"\bwrong\b",
        r"\bunreliable\b",
        r"\boverrated\b",
        r"\bdeclin(?:e[sd]?|ing)\b",
    ]),
    ("technical_discussion", [
        r"\bapi\b",
        r"\bbenchmark(?:s|ing)?\b",
        r"\bmodel\b",
        r"\btoken(?:s)?\b",
        r"\bcontext window\b",
        r"\blatency\b",
        r"\bperformance\b",
        r"\barchitecture\b",
        r"\bimplementation\b",
        r"\bopen[- ]source\b",
        r"\bfine[- ]tun(?:e[sd]?|ing)\b",
        r"\bprompt(?:s|ing)?\b",
        r"\bembedding[s]?\b",
        r"\binference\b",
        r"\btraining\b",
        r"\bhow (?:to|i|we)\b",
        r"\bbuilt?\b",
        r"\busing\b",
        r"\bcode\b",
        r"\bself[- ]host(?:ed|ing)?\b",
        r"\bgithub\b",
        r"\bcli\b",
    ]),
]


@dataclass(frozen=True)
class Topic:
    """A tracked subject: `name` labels rows, `query` is the search term (metadata)."""

    name: str
    query: str = ""


@dataclass(frozen=True)
class SentimentRules:
    """Word lists and weights of the lexicon score (Hutto & Gilbert, 2014)."""

    # Words that strengthen or weaken a following scored word.
    stronger: tuple[str, ...] = (
        "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably",
        "decidedly", "deeply", "effing", "enormous", "enormously", "entirely", "especially",
        "exceptional", "exceptionally", "extreme", "extremely", "fabulously", "flipping",
        "flippin", "frackin", "fracking", "fricking", "frickin", "frigging", "friggin", "fully",
        "fuckin", "fucking", "fuggin", "fugging", "greatly", "hella", "highly", "hugely",
        "incredible", "incredibly", "intensely", "major", "majorly", "more", "most",
        "particularly", "purely", "quite", "really", "remarkably", "so", "substantially",
        "thoroughly", "total", "totally", "tremendous", "tremendously", "uber", "unbelievably",
        "unusually", "utter", "utterly", "very",
    )
    weaker: tuple[str, ...] = (
        "almost", "barely", "hardly", "just enough", "kind of", "kinda", "kindof", "kind-of",
        "less", "little", "marginal", "marginally", "occasional", "occasionally", "partly",
        "scarce", "scarcely", "slight", "slightly", "somewhat", "sort of", "sorta", "sortof",
        "sort-of",
    )
    # Negating words. Any word holding n't negates too.
    negations: tuple[str, ...] = (
        "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "dont",
        "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither", "neednt", "never",
        "none", "nope", "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt",
        "uhuh", "uh-uh", "wasnt", "werent", "without", "wont", "wouldnt", "rarely", "seldom",
        "despite",
    )
    # Phrases that carry a score of their own.
    idioms: tuple[tuple[str, float], ...] = (
        ("the shit", 3.0), ("the bomb", 3.0), ("bad ass", 1.5), ("badass", 1.5),
        ("bus stop", 0.0), ("yeah right", -2.0), ("kiss of death", -1.5), ("to die for", 3.0),
        ("beating heart", 3.1), ("broken heart", -2.9),
    )
    contrast: str = "but"
    # Weights.
    step: float = 0.293
    caps: float = 0.733
    negate: float = -0.74
    norm: float = 15.0


@dataclass(frozen=True)
class RunSettings:
    """Everything one run needs besides the data."""

    topics: tuple[Topic, ...]
    source: str = DEFAULT_SOURCE
    permalink_prefix: str = PERMALINK_PREFIX
    hits_per_page: int = HITS_PER_PAGE
    # None reads every accepted page of every topic.
    max_items_per_topic: int | None = None
    positive_threshold: float = POSITIVE_THRESHOLD
    negative_threshold: float = NEGATIVE_THRESHOLD
    rules: list[tuple[str, list[str]]] = field(default_factory=lambda: CATEGORY_RULES)
    categories: tuple[str, ...] = tuple(name for name, _ in CATEGORY_RULES)
    lexicon: dict[str, float] | None = None
    sentiment_rules: SentimentRules = field(default_factory=SentimentRules)
    sample_size: int = SAMPLE_SIZE
    sample_seed: int = SAMPLE_SEED
    top_items_per_topic: int = TOP_ITEMS_PER_TOPIC

    def __post_init__(self) -> None:
        if not self.topics:
            raise ValueError("at least one topic is needed")
        names = [t.name for t in self.topics]
        if not all(names):
            raise ValueError("every topic needs a name")
        if len(set(names)) != len(names):
            raise ValueError(f"topic names must be unique: {names}")
        if self.hits_per_page < 1:
            raise ValueError("hits_per_page must be positive")
        if FALLBACK_CATEGORY not in self.categories:
            object.__setattr__(self, "categories", (*self.categories, FALLBACK_CATEGORY))

    @property
    def max_pages(self) -> int | None:
        if self.max_items_per_topic is None:
            return None
        return -(-self.max_items_per_topic // self.hits_per_page)
