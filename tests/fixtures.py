"""Sample inputs of the reference jobs (see FIXTURES.md) -- fixed values."""

# FIXED VALUES: the reference jobs' built-in sample data, verbatim.
SOLILOQUY = [
    "To be, or not to be,--that is the question:--",
    "Whether 'tis nobler in the mind to suffer",
    "The slings and arrows of outrageous fortune",
    "Or to take arms against a sea of troubles,",
    "And by opposing end them?--To die,--to sleep,--",
    "No more; and by a sleep to say we end",
    "The heartache, and the thousand natural shocks",
    "That flesh is heir to,--'tis a consummation",
    "Devoutly to be wish'd. To die,--to sleep;--",
    "To sleep! perchance to dream:--ay, there's the rub;",
    "For in that sleep of death what dreams may come,",
    "When we have shuffled off this mortal coil,",
    "Must give us pause: there's the respect",
    "That makes calamity of so long life;",
    "For who would bear the whips and scorns of time,",
    "The oppressor's wrong, the proud man's contumely,",
    "The pangs of despis'd love, the law's delay,",
    "The insolence of office, and the spurns",
    "That patient merit of the unworthy takes,",
    "When he himself might his quietus make",
    "With a bare bodkin? who would these fardels bear,",
    "To grunt and sweat under a weary life,",
    "But that the dread of something after death,--",
    "The undiscover'd country, from whose bourn",
    "No traveller returns,--puzzles the will,",
    "And makes us rather bear those ills we have",
    "Than fly to others that we know not of?",
    "Thus conscience does make cowards of us all;",
    "And thus the native hue of resolution",
    "Is sicklied o'er with the pale cast of thought;",
    "And enterprises of great pith and moment,",
    "With this regard, their currents turn awry,",
    "And lose the name of action.--Soft you now!",
    "The fair Ophelia!--Nymph, in thy orisons",
    "Be all my sins remember'd.",
]

ONE_LINE = ["To be, or not to be,--that is the question:--"]

WINDOW_WORDS = [
    "hello world",
    "hello thank you",
    "hello i am fine",
    "Are you ok",
    "xiaomi",
    "huawei",
    "Lenovo",
    "vivo oppo",
    "apple google",
    "Bytedance",
    "Bytedance",
    "Bytedance",
    "Bytedance",
    "Bytedance",
]

SESSION_ROWS = [  # (key, t_ms, value) in arrival order
    ("a", 1, 1), ("b", 1, 1), ("b", 3, 1), ("b", 5, 1), ("c", 6, 1), ("b", 7, 1), ("b", 9, 1),
    ("b", 12, 1), ("b", 16, 1), ("a", 10, 1), ("c", 11, 1), ("d", 11, 1),
]


# FIXED VALUES: the sample tweets' text and the expected rolling counts.
SAMPLE_TWEET_TEXT = "Apache Flink"
TWEET_COUNTS = [("apache", 1), ("apache", 2), ("apache", 3), ("flink", 1), ("flink", 2), ("flink", 3)]


def tweet(i: int, text: str = SAMPLE_TWEET_TEXT, lang: str = "en") -> str:
    """A tweet-shaped record (fields read: ``text`` and ``user.lang``; the
    rest is padding with nested objects, arrays and nulls)."""
    return ('{"created_at":"Mon Jan 1 00:00:00 +0000 1901","id":%d,"text":"%s","source":null,'
            '"user":{"id":0,"name":"someone","lang":"%s",'
            '"entities":{"hashtags":[{"text":"example%d","indices":[0,0]}]}},"geo":null}' % (i, text, lang, i))


TWEETS = [tweet(i) for i in range(3)]

# (speed km/h, distance m, ts ms) for one car; FIXTURES.md §2
TELEMETRY = [(50, 0.0, 0), (90, 50.0, 1000), (70, 60.0, 2000), (90, 115.0, 12000), (90, 130.0, 13000),
             (80, 166.0, 14000)]
