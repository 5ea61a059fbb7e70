"""The message relation, the character card, and the fixed values the operators must share with their readers."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, MapType, StringType, StructField, StructType

#: one row per message, in order of (src, seq)
MESSAGES = StructType([StructField("src", StringType()), StructField("seq", LongType()), StructField("ts_raw", StringType()), StructField("sender", StringType()), StructField("content", StringType())])

# fixed values: tokens, sets of characters and thresholds of the style profile
BRACKET = r"\[[^\[\]]{1,12}\]"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{FE0F}\x{2B00}-\x{2BFF}]"
STOP_CHARACTERS = "的了是我你他她它们呢吧啊呀哦哈嘛么在有不没就都也很要这那个人什"
PHRASE_ENDS = "~？！?!。，,、"
TAILS = "！？。~…?!,，哈嘿嘻呵嗯啦呀哦嘛"
SEPARATOR = "====="
LENGTH_BUCKETS = ((1, 0, 5), (2, 6, 20), (3, 21, 100), (4, 101, None))
TOP_TOKENS, TOP_PHRASES, TOP_GRAMS, SHOWN_GRAMS, LEAST_GRAMS, TOP_TAILS, SHOWN_BURSTS = 30, 80, 800, 50, 50, 15, 8

# fixed values: keys under which exports keep their messages, and names of their fields
MESSAGE_KEYS = ("messages", "data", "chat", "records", "msg")
TIME_FIELDS = ("time", "timestamp", "createTime", "date", "ts")
SENDER_FIELDS = ("sender", "senderName", "from", "talker", "nickname", "name")
CONTENT_FIELDS = ("content", "text", "message", "msg")
TYPE_FIELDS = ("type", "msgType")
TEXT_TYPES = ("1", "text", "Text", "message", "Message")

# fixed values: rules of the privacy scan, in order: label, English label, pattern
PRIVACY_RULES = (
    ("手机号", "phone number", r"(?<!\d)1[3-9]\d{9}(?!\d)"),
    ("身份证", "national ID", r"(?<!\d)\d{17}[\dXx](?!\d)"),
    ("邮箱", "email", r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.]{2,}"),
    ("微信号", "WeChat ID", r"wxid_[A-Za-z0-9_]{4,}"),
    ("本机路径", "local path", r"[A-Za-z]:\\\\Users\\\\[^\\\\\s\"']+|/(?:Users|home)/[A-Za-z0-9._-]+"),
    ("IP 地址", "IP address", r"(?<!\d)(?:\d{1,3}\.){3}\d{1,3}(?!\d)"),
    ("疑似密钥", "possible secret", r"(?:sk|pk)-[A-Za-z0-9]{16,}"),
)
SKIPPED_DIRECTORIES = (".git", "node_modules", "__pycache__", ".venv", "venv", ".idea", ".vscode")
BINARY_SUFFIXES = (
    ".png", ".jpg", ".jpeg", ".gif", ".webp", ".ico", ".bmp", ".svg", ".mp3", ".mp4", ".wav", ".zip", ".gz", ".tar", ".7z", ".rar",
    ".exe", ".dll", ".so", ".pyc", ".pdf", ".woff", ".woff2", ".ttf", ".bin",
)
MOST_BYTES = 2 * 1024 * 1024

# fixed values: fields of a card, and the limits of its checks
CARD_FIELDS = ("name", "description", "personality", "scenario", "first_mes", "mes_example")
MOST_GREETING_LINES, MOST_EXAMPLE_LINES = 6, 5

_ENTRY = StructType([
    StructField("keys", ArrayType(StringType())), StructField("content", StringType()), StructField("enabled", BooleanType()),
    StructField("insertion_order", IntegerType()), StructField("extensions", MapType(StringType(), StringType())),
])
_CARD_BODY = [
    *[StructField(f, StringType()) for f in ("name", "description", "personality", "scenario", "first_mes", "mes_example", "creator_notes", "system_prompt", "post_history_instructions")],
    StructField("alternate_greetings", ArrayType(StringType())),
    StructField("character_book", StructType([StructField("name", StringType()), StructField("entries", ArrayType(_ENTRY))])),
    StructField("extensions", MapType(StringType(), StringType())),
]
#: a card with an envelope (data), or flat as in the first version
CARD = StructType([StructField("spec", StringType()), StructField("spec_version", StringType()), StructField("data", StructType(_CARD_BODY)), *_CARD_BODY])
