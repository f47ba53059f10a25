"""Data contracts: column types, status words and the constants rules refer to."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: status vocabularies -------------------------------------
ETL_PENDING = "pending"
ETL_IN_PROGRESS = "in_progress"
ETL_DONE = "done"
ETL_FAILED = "failed"
ETL_STATUSES = (ETL_PENDING, ETL_IN_PROGRESS, ETL_DONE, ETL_FAILED)

LEAD_PROCESSED = "processed"
LEAD_QUEUED = "queued_for_training"

INFERENCE_PENDING = "pending"
INFERENCE_PROCESSING = "processing"
INFERENCE_ERROR = "error"
INFERENCE_COMPLETED = "completed"

# ---- fixed values: chat record ---------------------------------------------
CHAT_ROLES = ("system", "user", "assistant")
LEAD_PREFIX = "Lead conversation:\n"
BATCH_TOKEN = "[1-34]"

# ---- fixed values: reject reasons ------------------------------------------
WRONG_LENGTH = "conversations length=%d, expected 3"
EMPTY_USER = "Empty user content after PII clean"
EMPTY_ASSISTANT = "Empty assistant content after PII clean"
NULL_USER = "null user content"
NULL_ASSISTANT = "null assistant content"
REJECTED = "Quality check failed: "

# The prompt is data, not logic: pass the one your model was tuned with.
DEFAULT_SYSTEM_PROMPT = (
    "You are a lead qualification assistant. Read the conversation and answer with one JSON object."
)

# ---- fixed values: inference request parameters ----------------------------
GENERATION_PARAMETERS = {"max_new_tokens": 512, "temperature": 0.1, "do_sample": True}
INPUT_PREFIX = "inference-inputs/"
OUTPUT_PREFIX = "inference-outputs/"

# ---- fixed values: label rules ---------------------------------------------
LABEL_INTENTS = ("buy", "rent", "invest", "browse")
LABEL_URGENCIES = ("hot", "warm", "cold")
LABEL_ACTIONS = ("agent_call", "schedule_showing", "follow_up_email", "nurture_sequence", "drop")
INTENT_MIX = {"buy": 10, "rent": 6, "invest": 6, "browse": 5, "drop": 3}
SCORE_TIERS = ((85, 100), (65, 84), (40, 64), (15, 39), (5, 14), (0, 4))
BATCH_SIZE = 30
BRAND_LIMIT = 6
DROP_MAX_SCORE = 4
NO_BRAND = "N/A"

# ---- fixed values: run control ---------------------------------------------
LEADS_PER_DISPATCH = 50
TRIGGER_THRESHOLD = 1000
MAX_PERPLEXITY = 8.0
MAX_LOSS = 2.0
MISSING_METRIC = 999.0
TIER_EXCELLENT_BELOW = 0.5
TIER_GOOD_BELOW = 1.5

# ---- fixed values: training arrays -----------------------------------------
IGNORE_LABEL = -100
MAX_SEQ_LENGTH = 2048

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
CONVERSATIONS = T.ArrayType(MESSAGE)
CHAT = T.StructType([T.StructField("conversations", CONVERSATIONS)])

LABEL = T.StructType(
    [
        T.StructField("intent", T.StringType()),
        T.StructField("urgency", T.StringType()),
        T.StructField("budget_range", T.StringType()),
        T.StructField("timeline_months", T.IntegerType()),
        T.StructField("preferred_locality", T.StringType()),
        T.StructField("property_type", T.StringType()),
        T.StructField("brand_fit", T.StringType()),
        T.StructField("next_action", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("reasoning", T.StringType()),
    ]
)

PROCESSED_MESSAGE = T.StructType(
    [
        T.StructField("source_mongo_id", T.StringType()),
        T.StructField("batch_num", T.LongType()),
        T.StructField("record_index", T.LongType()),
        T.StructField("conversations", CONVERSATIONS),
        T.StructField("metadata", T.StructType([T.StructField("system_prompt", T.StringType())])),
    ]
)

PROCESSED_DOC = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("conversations", CONVERSATIONS),
        T.StructField("etl_status", T.StringType()),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("system_prompt", T.StringType()),
                    T.StructField("batch_num", T.LongType()),
                    T.StructField("record_index", T.LongType()),
                ]
            ),
        ),
    ]
)

TOPIC_ROW = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
    ]
)
