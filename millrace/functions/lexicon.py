"""Lexicons: plain data that the scores take as an argument."""

from __future__ import annotations

from dataclasses import dataclass

OFF_DOMAIN = "programming_offdomain"
EMOTIONAL = "emotional_support"


@dataclass(frozen=True)
class Lexicon:
    topics: dict[str, list[str]]
    emotions: list[str]
    actions: list[str]
    collaborative: list[str]
    second_person: list[str]
    absolutes: list[str]
    openers: list[str]
    fallback: list[str]
    questions: tuple[str, ...] = ("?", "？")
    # A number with a unit (in any case), and the start of a list (in any line).
    unit_regex: str = (
        r"(\d+\s?(kg|g|calories?|sets?|reps?|minutes?|hours?|days?|weeks?))|"
        r"(\d+\s?(组|次|秒|分钟|小时|天|周|公斤|千卡|克))"
    )
    list_regex: str = r"(^|\n)\s*(?:[-*]|\d+[.)、])\s+"


# The stock word lists.
STOCK = Lexicon(
    topics={
        "strength_training": ["strength", "hypertrophy", "bench", "squat", "deadlift", "reps", "sets", "progressive overload", "力量训练", "深蹲", "硬拉", "卧推", "增肌", "训练计划"],
        "running_cardio": ["running", "runner", "marathon", "cardio", "jog", "有氧", "跑步", "马拉松"],
        "nutrition": ["protein", "calorie", "diet", "carb", "fat", "meal prep", "supplement", "nutrition", "蛋白质", "热量", "饮食", "碳水", "脂肪", "营养", "补剂", "减脂"],
        "recovery_sleep": ["recovery", "sleep", "soreness", "rest day", "deload", "恢复", "睡眠", "酸痛", "休息", "疲劳"],
        "injury_pain": ["injury", "pain", "rehab", "shoulder", "knee", "back pain", "疼痛", "受伤", "肩", "膝", "腰"],
        "motivation_adherence": ["motivation", "habit", "consistency", "plateau", "stress", "坚持", "动力", "习惯", "平台期", "压力"],
        "gym_etiquette": ["share equipment", "gym etiquette", "bench press station", "交替使用", "器械", "健身房礼仪"],
        "bodybuilding_prep": ["competition prep", "bodybuilding", "stage", "peak week", "备赛", "健美", "比赛"],
        EMOTIONAL: ["mental health", "depression", "anxiety", "anxious", "therapist", "counselor", "lonely", "worthless", "panic", "suicid", "心理", "焦虑", "抑郁", "情绪", "难过", "沮丧", "咨询", "治疗"],
        OFF_DOMAIN: ["python", "javascript", "java", "html", "css", "sql", "module.exports", "```", "代码", "程序", "函数"],
    },
    emotions=["frustrated", "anxious", "overwhelmed", "discouraged", "stressed", "burned out", "ashamed", "worried", "guilty", "疲惫", "焦虑", "沮丧", "压力", "担心", "崩溃", "难受", "不舒服", "烦"],
    actions=["recommend", "suggest", "start with", "focus on", "keep", "track", "adjust", "plan", "建议", "推荐", "保持", "记录", "调整", "计划", "先", "逐步", "安排"],
    collaborative=["let's", "we can", "together", "我们", "可以先", "可以把"],
    second_person=["you", "your", "你", "你的", "我们"],
    absolutes=["always", "never", "guarantee", "cure", "must avoid", "all you need", "一定", "绝对", "保证", "治愈", "完全不用"],
    openers=["of course", "sure", "great question", "as an ai", "当然可以", "你好", "您好", "很高兴"],
    fallback=["coach", "goal", "habit", "plan", "训练", "健身", "目标", "计划"],
)

#: Words of the invented prose in the test tables, so that every branch of the scores has rows.
FIXTURE = Lexicon(
    topics={
        "strength_training": ["ung ", "from "],
        "running_cardio": ["que "],
        "nutrition": ["les "],
        "recovery_sleep": ["with "],
        EMOTIONAL: ["ción ", "this "],
        OFF_DOMAIN: ["license", " by by"],
    },
    emotions=["and "],
    actions=["the "],
    collaborative=["der "],
    second_person=[" to "],
    absolutes=["was the"],
    openers=["in", "de", "the"],
    fallback=["ea ", "en "],
    questions=(" the of", "?"),
    unit_regex=r"(?:of|die) (?:the|der|in)",
    list_regex=r"^(?:In|De|The|Of) ",
)

# Tags and source sets of the composition rules.
FITNESS_TAGS = [
    "bodybuilding_prep",
    "gym_etiquette",
    "injury_pain",
    "nutrition",
    "recovery_sleep",
    "running_cardio",
    "strength_training",
]
# Acknowledgement, advice and raw memory fields of the response scores.
ACKNOWLEDGE = [
    r"\bthat(?:'s| is)\b",
    r"\b(i get it|i hear you|i understand)\b",
    r"\b(makes sense)\b",
    r"\b(sounds like)\b",
    r"\b(feel|feeling|frustrat|guilt|guilty|fear|afraid|exhausted|tired|drained)\b",
    r"\b(genuinely|understandably)\b",
]
ADVISE = [
    r"\b(try|start|focus|aim|consider|adjust|shift|keep|use|plan|do)\b",
    r"\b(you should|let's|i'd)\b",
]
RAW_FIELDS = [
    "current_weight_kg",
    "goal_weight_kg",
    "training_days_per_week",
    "protein_target_g",
    "calorie_target",
    "recent_events:",
]
RISKY_CLAIMS = ["guarantee", "cure", "always", "never", "prescribe", "diagnose", "everyone needs", "all you need"]
# Role aliases and the keys tried in raw records.
ROLE_ALIASES = {
    "assistant": "assistant",
    "bot": "assistant",
    "coach": "assistant",
    "gpt": "assistant",
    "model": "assistant",
    "user": "user",
    "human": "user",
    "client": "user",
    "system": "system",
    "developer": "system",
}
CONVERSATION_KEYS = ["conversations", "messages", "dialogue", "dialog", "chat"]
ROLE_KEYS = ["role", "speaker", "from", "author"]
CONTENT_KEYS = ["content", "text", "value", "message"]
PROMPT_KEYS = ["instruction", "prompt", "question", "query", "user", "human", "context"]
ANSWER_KEYS = ["output", "response", "answer", "assistant", "gpt"]
