"""Spark types of the records that pass between the steps."""

from pyspark.sql import types as T

FINDING = "struct<type:string,method:string,count:int,masked_as:string>"
RESIDUAL = "struct<type:string,count:int>"
SEMANTIC_ITEM = "struct<type:string,value:string>"
VERDICT = (
    "struct<is_phishing:boolean,risk_score:double,mitre_technique:string,"
    "why_malicious_context:string,high_risk_tokens:array<string>>"
)

MAIL = T.StructType(
    [
        T.StructField("email_id", T.LongType()),
        T.StructField("raw_email", T.StringType()),
        T.StructField("true_label", T.StringType()),
    ]
)
LABELLED_MAIL = T.StructType(
    [T.StructField("raw_email", T.StringType()), T.StructField("true_label", T.StringType())]
)
TECHNIQUE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "name", "description", "indicators")]
)
EXAMPLE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("email", "label", "technique", "reason")]
)
STORED_VERDICT = T.StructType(
    [
        T.StructField("sender_domain", T.StringType()),
        T.StructField("email_body", T.StringType()),
        T.StructField("is_phishing", T.BooleanType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("mitre_technique", T.StringType()),
        T.StructField("why_malicious_context", T.StringType()),
        T.StructField("high_risk_tokens", T.ArrayType(T.StringType())),
        T.StructField("true_label", T.StringType()),
    ]
)
MASKED_TEXT = T.StructType(
    [T.StructField("unmasked_text", T.StringType()), T.StructField("masked_text", T.StringType())]
)
GOLDEN = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("subject", T.StringType()),
        T.StructField("snippet", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("locale", T.StringType()),
        T.StructField("predicted_score", T.DoubleType()),
    ]
)
