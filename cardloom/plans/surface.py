"""Model tables as SQL views and the indicators as SQL functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The functions are for single ids in interactive SQL; over whole tables use
# the set-based forms in cardloom.operators.indicators.
FUNCTIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION fn_calc_taux_fraude_carte(p_id_carte BIGINT) RETURNS DECIMAL(9,4)
    RETURN SELECT coalesce(max(taux_fraude_pct), 0) FROM v_card_aggregates WHERE id_carte = p_id_carte""",
    """CREATE OR REPLACE TEMPORARY FUNCTION fn_carte_a_risque(p_id_carte BIGINT) RETURNS STRING
    RETURN SELECT if(coalesce(max(taux_fraude_pct), 0) >= 5, 'Y', 'N') FROM v_card_aggregates
      WHERE id_carte = p_id_carte""",
    """CREATE OR REPLACE TEMPORARY FUNCTION fn_calc_score_risque_client(p_id_client BIGINT) RETURNS DECIMAL(5,2)
    RETURN SELECT max(score_risque) FROM v_client_risk WHERE id_client = p_id_client""",
    """CREATE OR REPLACE TEMPORARY FUNCTION fn_get_libelle_mcc(p_code_mcc INT) RETURNS STRING
    RETURN coalesce((SELECT max(libelle_mcc) FROM mcc WHERE code_mcc = p_code_mcc),
      concat('MCC inconnu (', p_code_mcc, ')'))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION fn_get_user_id(p_login STRING) RETURNS INT
    RETURN SELECT if(count(*) = 1, max(id_utilisateur), 0) FROM utilisateur_si WHERE upper(login) = upper(p_login)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION fn_transactions_client(p_id_client BIGINT)
    RETURNS TABLE(id_transaction BIGINT, date_transaction TIMESTAMP, amount DECIMAL(12,2), is_fraud STRING)
    RETURN SELECT id_transaction, date_transaction, amount, is_fraud FROM v_transactions_enrichies
      WHERE id_client = p_id_client""",
)


def register(spark: SparkSession, t: dict[str, DataFrame]) -> None:
    """Registers tables, the plain views and the functions in this session."""
    from cardloom.operators import datamarts, enrich, indicators

    for name, df in t.items():
        df.createOrReplaceTempView(name)
    tx, label = t["transaction"], t["label_fraude"]
    mart = datamarts.card_datamart(tx, label)
    views = {
        "v_transactions_enrichies": enrich.enriched(tx, t["carte"], t["client"], t["marchand"], t["mcc"], label),
        "v_clients_avec_cartes": datamarts.client_cards(t["client"], t["carte"]),
        "v_marchands_par_volume": datamarts.merchant_volume(tx, t["marchand"], t["mcc"]),
        "v_card_aggregates": mart,
        "v_daily_aggregates": datamarts.daily_datamart(tx, label),
        "v_mcc_aggregates": datamarts.category_datamart(tx, t["marchand"], t["mcc"]),
        "v_client_risk": indicators.client_risk(t["client"], t["carte"], mart),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    for statement in FUNCTIONS:
        spark.sql(statement)
