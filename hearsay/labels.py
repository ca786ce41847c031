"""Enum literals, thresholds and report texts shared by the operators."""

# --- fixed values: enum literals carried by the data -------------------------
NEGATIVE = "负面"
POSITIVE = "正面"
DESCRIPTOR = "描述词"
EVENT_WORD = "事件词"

# --- fixed values: scoring ----------------------------------------------------
INDICATORS = 11
DEFAULT_RISK = 100.0
# upper bound in hours (exclusive) -> weight; anything older gets DECAY_REST
DECAY = [(0.5, 2.5), (1.0, 2.0), (168.0, 1.5), (5040.0, 1.25), (30240.0, 1.0)]
DECAY_REST = 0.5
DECAY_MALFORMED = 1.0

RED, ORANGE, YELLOW, GREEN = "红色", "橙色", "黄色", "绿色"
WARN_RED_BELOW = 50.0
WARN_ORANGE_UP_TO = 77.0
WARN_UP_TO = 88.0
LABEL_RED_UP_TO = 53.52
LABEL_YELLOW_UP_TO = 89.34

# --- fixed values: report -----------------------------------------------------
HEALTH_CAP = 99.0
# lower bound (inclusive) -> level, advice
HEALTH_LEVELS = [
    (96, "健康", "网信健康管理需整体统筹，自身、家人、朋友及同事均是管理的重要一环，请勿忽视。"),
    (81, "良好", "网信健康管理需整体统筹，自身、家人、朋友及同事均是管理的重要一环，请勿忽视。"),
    (62, "亚健康", "网信健康风险的变化是动态但有迹可循的，请保持定期评测的良好习惯，防患未然。"),
    (44, "微恙", "网信健康管理是一个长期的、与己有益的过程，请务必坚持。"),
]
HEALTH_LOWEST = ("危重", "网信健康管理是一个长期的、与己有益的过程，请务必坚持。")
INDENT = " " * 8
EMPTY_REPORT = (
    f"{INDENT}您本次的网信健康综合评测结果为：健康。\n"
    f"{INDENT}网信健康管理是一个长期、持续的过程，关注您的家人、朋友及同事的关联风险也是管理的"
    "重要一环。请您务必保持定期评测的良好习惯，防患未然。"
)
REPORT_RESULT = "您本次的网信健康综合评测结果为："
REPORT_NOW = "现阶段，"
REPORT_WATCH = "将密切关注相关舆情动向，助您及时发现舆情异常状态。"
RATIO_SLOT = "result_ratio"
NEW_EVENT_SLOT = "new_event_desc"
RATIO_UP = "，健康度环比上升"
RATIO_DOWN = "，健康度环比下降"
RATIO_SAME = "，健康度环比无变化。"
EVENTS_ALL = "与您相关的事件共"
EVENTS_RISK = "与您相关的风险事件共"
EVENTS_UNIT = "个"
EVENTS_NEW = "，新增"
EVENTS_HIGH = "类高风险事件"

# --- fixed values: events -----------------------------------------------------
EVENT_THRESHOLD = 0.551
VALIDATION_THRESHOLD = 0.5
EVENT_WARN_RISK = 12.0
NEVER_TESTED = "2100-12-12 00:00:00"
# section number -> look-back in days
SECTIONS = {3: 365, 2: 90, 1: 30}

# --- fixed values: text -------------------------------------------------------
QUOTED_TITLE = r"[“《#][\x{4e00}-\x{9fa5}\w,， ]{5,}[#》”]"
TITLE_MARKS = r"[,；，。【】?？!！—\-_]|[./]{2,}|发布了头条文章："
TITLE_NOISE = r"&quot;|\[转帖\]|转载"
SENTENCE_MARKS = r"[。！？.!?]"
SUMMARY_MARKS = r"[。？?!！；;▪]|</p>|<p>"
SUMMARY_NOISE = r"网页链接|我发表了头条文章:"
TOKEN_NOISE = r"尊敬的读者[.]+|网页链接|<p>|</p>"
