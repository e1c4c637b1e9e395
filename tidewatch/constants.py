"""Fixed values.

Everything in the first block must equal the values the original service
uses, or results differ.  They are written out plainly, in the order the
original lists them.  Values in the second block are our own defaults for
caller-supplied tables (the original takes them from third-party packages or
from data files it does not ship).
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original service)
# ---------------------------------------------------------------------------

# Language markers.
FRENCH_MARKERS = ["le", "la", "les", "de", "du", "des", "et", "est", "une", "un",
                  "dans", "sur", "avec", "pour"]
ENGLISH_MARKERS = ["the", "and", "is", "are", "of", "to", "in", "on", "with", "for",
                   "at", "by"]

# Urgency word groups (T5), each counted as whole words, plus one run of
# warning symbols: U+1F6A8 U+26A1 U+1F525 U+1F4A5 U+26D4 U+1F534 U+26A0 U+FE0F.
URGENCY_WORD_GROUPS = [
    ["breaking", "urgent", "alert", "emergency", "crisis"],
    ["immediate", "critical", "severe", "massive"],
    ["collapse", "crash", "plunge", "surge", "spike"],
]
URGENCY_SYMBOLS = ["\U0001F6A8", "⚡", "\U0001F525", "\U0001F4A5", "⛔",
                   "\U0001F534", "⚠", "️"]

# Movement words.
MOVEMENT_WORDS = ["up", "down", "gained", "lost", "rose", "fell", "increased", "decreased"]
POSITIVE_MOVEMENTS = ["up", "gained", "rose", "increased"]
NEGATIVE_MOVEMENTS = ["down", "lost", "fell", "decreased"]

# Trade-context lexicon (T18): term, weight.
TRADE_POSITIVE = [
    ("breakthrough", 2.5), ("agreement", 2.0), ("deal", 1.8), ("cooperation", 1.7),
    ("partnership", 1.6), ("resolution", 1.9), ("success", 1.8), ("progress", 1.5),
    ("win-win", 2.2), ("beneficial", 1.6), ("opportunity", 1.4), ("growth", 1.5),
]
TRADE_NEGATIVE = [
    ("war", -2.5), ("crisis", -2.3), ("collapse", -2.8), ("failure", -2.1),
    ("retaliation", -2.0), ("sanctions", -1.9), ("embargo", -2.2), ("tariffs", -1.5),
    ("escalation", -2.1), ("breakdown", -2.0), ("deadlock", -1.8), ("tensions", -1.6),
    ("disruption", -1.7), ("uncertainty", -1.4), ("volatility", -1.3),
]
TRADE_LEXICON = TRADE_POSITIVE + TRADE_NEGATIVE

# Organisation names (T10), matched case-sensitively as substrings, in this order.
ORGANISATIONS = [
    "Apple", "Microsoft", "Google", "Amazon", "Tesla", "Meta", "NVIDIA", "Intel", "AMD",
    "Qualcomm", "Huawei", "Samsung", "TSMC", "Toyota", "Ford", "GM", "BMW", "Mercedes",
    "Volkswagen", "Honda", "Nissan", "Hyundai", "BYD", "NIO", "Caterpillar", "GE",
    "Siemens", "Bosch", "ABB", "Honeywell", "ExxonMobil", "Shell", "BP", "Chevron",
    "TotalEnergies", "ConocoPhillips", "Sinopec", "PetroChina", "Gazprom", "Saudi Aramco",
    "Cargill", "ADM", "Tyson Foods", "JBS", "Nestle", "Unilever", "JPMorgan",
    "Bank of America", "Wells Fargo", "Goldman Sachs", "Morgan Stanley", "Citi", "HSBC",
    "Deutsche Bank", "Credit Suisse",
]

# Place names (T11), same matching.
PLACES = [
    "USA", "United States", "China", "Germany", "Japan", "France", "UK", "United Kingdom",
    "Canada", "Mexico", "Brazil", "India", "Australia", "South Korea", "Italy", "Spain",
    "Netherlands", "Switzerland", "Singapore", "Hong Kong", "Taiwan", "Russia",
    "South Africa",
]

# Countries tagged by the feed producer.
PRODUCER_COUNTRIES = ["USA", "China", "Germany", "Japan", "France", "UK", "Canada", "Mexico"]

# Crisis terms boosting keyword bursts.
CRISIS_TERMS = ["crisis", "emergency", "collapse", "breakdown", "urgent", "critical"]

# Priority -> volume factor.
PRIORITY_FACTORS = {"low": 0.5, "normal": 1.0, "high": 2.0, "critical": 3.0}

# Detector parameters.
SHORT_WINDOW_S, MEDIUM_WINDOW_S, LONG_WINDOW_S = 300, 1800, 7200
SHORT_CAP, MEDIUM_CAP, LONG_CAP = 100, 200, 500
REFRESH_EVERY = 100  # posts between two baseline refreshes
VOLUME_SPIKE_Z = 3.0
SENTIMENT_SHIFT = 0.4
KEYWORD_Z = 2.5
ENGAGEMENT_SPIKE_Z = 4.0
MIN_SAMPLES = 10
CRITICAL_CUT, HIGH_CUT, MEDIUM_CUT = 0.8, 0.6, 0.4
COMPOSITE_WEIGHTS = {"volume": 0.30, "sentiment": 0.25, "keyword": 0.25, "engagement": 0.20}
DEFAULT_BASELINES = {"volume": (10.0, 3.0), "sentiment": (0.0, 0.3), "engagement": (15.0, 8.0)}
KEYWORD_DECAY, KEYWORD_FLOOR = 0.95, 0.1

# Ensemble weights (T21) and the three-method weights.
ENSEMBLE_WEIGHTS = {"valence": 0.6, "trade": 0.4}
THREE_METHOD_WEIGHTS = {"model": 0.3, "valence": 0.4, "trade": 0.3}

# Hour-of-day volume profile, hours 0..23.
HOUR_PROFILE = [0.3, 0.2, 0.15, 0.1, 0.1, 0.15, 0.25, 0.4, 0.6, 0.8, 1.0, 1.2,
                1.3, 1.4, 1.2, 1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3]
WEEKEND_FACTOR = 0.3
SCENARIO_FACTORS = {"normal": 1.0, "trade_war_escalation": 3.5, "breakthrough_deal": 2.8,
                    "supply_chain_crisis": 2.2, "market_uncertainty": 1.5, "realistic": 1.0}

# Region table (J1): country, region, latitude, longitude.
REGIONS = [
    ("USA", "North America", 39.8283, -98.5795), ("Canada", "North America", 56.1304, -106.3468),
    ("Mexico", "North America", 23.6345, -102.5528), ("Germany", "Europe", 51.1657, 10.4515),
    ("France", "Europe", 46.6034, 1.8883), ("UK", "Europe", 55.3781, -3.4360),
    ("Netherlands", "Europe", 52.1326, 5.2913), ("China", "Asia Pacific", 35.8617, 104.1954),
    ("Japan", "Asia Pacific", 36.2048, 138.2529), ("South Korea", "Asia Pacific", 35.9078, 127.7669),
    ("Singapore", "Asia Pacific", 1.3521, 103.8198), ("Brazil", "Other", -14.2350, -51.9253),
    ("India", "Other", 20.5937, 78.9629), ("Australia", "Other", -25.2744, 133.7751),
    ("South Africa", "Other", -30.5595, 22.9375),
]

# Severity table (D2, D4, D13): base priority, colour, recommended actions.
SEVERITY_BASE = {"low": 1.0, "medium": 2.0, "high": 3.0, "critical": 4.0}
SEVERITY_COLOURS = {"low": "#28a745", "medium": "#ffc107", "high": "#fd7e14",
                    "critical": "#dc3545"}
DEFAULT_COLOUR = "#6c757d"
ACTIONS = {
    "critical": ["Immediate investigation required", "Notify senior analysts",
                 "Monitor news sources for breaking developments", "Assess market impact"],
    "high": ["Increased monitoring recommended", "Review related tweets and sources",
             "Prepare situation report"],
    "other": ["Continue monitoring", "Log for trend analysis"],
}
ALERT_TYPE = "trade_sentiment_anomaly"

# Alert gate.
COOLDOWN_MINUTES = 15
MAX_ALERTS_PER_HOUR = 10
SIMILARITY_CUT = 0.8
RECENT_SENT_CONSULTED = 10
CRITICAL_OVERRIDE_MINUTES = 5

# ---------------------------------------------------------------------------
# OUR DEFAULTS for caller-supplied tables
# ---------------------------------------------------------------------------

# Small valence lexicon for T16, graded by hand: 1 mild, 2 clear, 3 strong.  The
# original uses a third-party lexicon; callers pass their own table.
VALENCE_LEXICON = [
    ("good", 2.0), ("great", 3.0), ("excellent", 3.0), ("positive", 3.0), ("gain", 2.0),
    ("gains", 2.0), ("growth", 2.0), ("win", 3.0), ("success", 3.0), ("strong", 2.0),
    ("progress", 2.0), ("partnership", 2.0), ("agreement", 2.0), ("deal", 1.0),
    ("lifts", 1.0), ("hope", 2.0), ("benefit", 2.0), ("improve", 2.0), ("boost", 2.0),
    ("bad", -3.0), ("poor", -2.0), ("negative", -3.0), ("loss", -1.0), ("losses", -2.0),
    ("crisis", -3.0), ("war", -3.0), ("fear", -2.0), ("risk", -1.0), ("weak", -2.0),
    ("fail", -3.0), ("failure", -2.0), ("collapse", -3.0), ("crash", -3.0), ("hits", -1.0),
    ("fell", -1.0), ("down", -1.0), ("uncertainty", -1.0), ("disruption", -2.0),
    ("tariffs", -1.0), ("threat", -2.0), ("worry", -2.0), ("breaking", -1.0),
]
NEGATIONS = ["not", "no", "never", "none", "nobody", "nothing", "neither", "nor",
             "cannot", "without", "isn't", "aren't", "wasn't", "don't", "doesn't",
             "didn't", "won't", "can't", "ne", "pas", "jamais"]
NEGATION_FACTOR = -0.74
BOOSTERS = [("very", 0.293), ("extremely", 0.293), ("highly", 0.293), ("really", 0.293),
            ("so", 0.293), ("most", 0.293), ("slightly", -0.293), ("somewhat", -0.293),
            ("barely", -0.293), ("hardly", -0.293), ("très", 0.293)]
CAPS_BOOST = 0.733
EXCLAIM_BOOST, EXCLAIM_MAX = 0.292, 4
VALENCE_ALPHA = 15.0

# Topic vocabulary for T23 (the original reads it from a file it does not ship).
TOPIC_VOCABULARY = ["tariffs", "trade deal", "exports", "imports", "supply chain",
                    "sanctions", "partnership", "growth", "prices", "shares"]

# ---- Fixed values: the stop-word lists of Spark's StopWordsRemover (English, French) ------

STOP_WORDS_ENGLISH = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split())

STOP_WORDS_FRENCH = tuple("""
au aux avec ce ces dans de des du elle en et eux il je la le les leur lui ma mais me même
mes moi mon ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi
ton tu un une vos votre vous c d j l à m n s t y été étée étées étés étant étante étants
étantes suis es est sommes êtes sont serai seras sera serons serez seront serais serait
serions seriez seraient étais était étions étiez étaient fus fut fûmes fûtes furent sois
soit soyons soyez soient fusse fusses fût fussions fussiez fussent ayant ayante ayantes
ayants eu eue eues eus ai as avons avez ont aurai auras aura aurons aurez auront aurais
aurait aurions auriez auraient avais avait avions aviez avaient eut eûmes eûtes eurent aie
aies ait ayons ayez aient eusse eusses eût eussions eussiez eussent
""".split())
