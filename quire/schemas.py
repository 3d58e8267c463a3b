"""Schema of the question table; the logs' schemas stand with their runs."""

from pyspark.sql import types as T

S = T.StringType()

# Question table as shipped in CSV form (index column first, unnamed).
QUESTIONS_CSV = T.StructType([
    T.StructField("_c0", S), T.StructField("qid", S), T.StructField("video_id", S),
    T.StructField("question_type", S), T.StructField("capability", S),
    T.StructField("question", S), T.StructField("duration", T.DoubleType()),
    T.StructField("question_prompt", S), T.StructField("answer", S),
    T.StructField("youtube_url", S),
])
