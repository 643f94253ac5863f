"""Declared schemas, so that no id is ever read as a number and no null is guessed."""

SEQUENCES = "id string, seq string"
ENTRY = "struct<kind: string, chain_ids: array<string>, sequence: string>"
PLAN = (
    "id string, json string, tokens bigint, pred string, tokens_check boolean, "
    "pred_isfile boolean, weight double, weight_cumsum double, batch_id bigint"
)
PLAN_COLUMNS = [
    "id", "json", "tokens", "pred", "tokens_check",
    "pred_isfile", "weight", "weight_cumsum", "batch_id",
]
ARTIFACTS = "kind string, id string, path string"
GPU_SAMPLES = (
    "index int, count int, ts timestamp, name string, util_gpu double, "
    "util_mem double, mem_total double, mem_free double, mem_used double"
)
SCORES = "ranking_score double, iptm double, ptm double"
MODEL_ARRAYS = (
    "id string, model int, plddt array<double>, logits array<array<array<double>>>"
)
