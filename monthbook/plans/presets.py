"""Ready-made book specifications by purpose."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from monthbook.operators.book import BookSpec, feature_book

# Columns, windows and aggregates of each preset.
BEHAVIOUR_PRESETS: dict[str, BookSpec] = {
    "churn": BookSpec(
        numeric=("dias_inatividade", "reducao_uso_percentual", "quantidade_reclamacoes",
                 "nps_score", "valor_lifetime"),
        categorical=("ultimo_canal_contato", "motivo_ultimo_contato", "segmento_valor"),
        windows=(1, 3, 6), aggregations=("avg", "max", "min", "std")),
    "cross_sell": BookSpec(
        numeric=("qtd_produtos_ativos", "valor_total_produtos", "tempo_relacionamento_meses",
                 "score_satisfacao"),
        categorical=("produtos_possui", "canal_aquisicao", "perfil_investidor"),
        windows=(3, 6, 12), aggregations=("sum", "avg", "max", "count")),
    "fraude": BookSpec(
        numeric=("valor_transacao", "frequencia_transacao", "distancia_media_transacoes",
                 "hora_transacao"),
        categorical=("pais_transacao", "tipo_estabelecimento", "tipo_cartao"),
        windows=(1, 7, 30), aggregations=("sum", "avg", "max", "std", "count")),
}

# Columns, ratios, counted values and windows of each preset.
MODEL_PRESETS: dict[str, BookSpec] = {
    "credito": BookSpec(
        numeric=("valor_fatura", "valor_pago", "limite_utilizado"),
        ratios={"valor_pago": "valor_fatura", "valor_utilizado": "limite_total",
                "qtd_atrasos": "qtd_faturas"},
        value_counts={"status_pagamento": ("PAGO", "ATRASADO", "MINIMO"),
                      "tipo_cliente": ("PRIME", "STANDARD")},
        windows=(1, 3, 6)),
    "fraude": BookSpec(
        numeric=("valor_transacao", "qtd_tentativas"),
        ratios={"valor_transacao": "media_historica",
                "qtd_tentativas_falha": "qtd_tentativas_total"},
        value_counts={"tipo_erro": ("SENHA_INVALIDA", "CARTAO_BLOQUEADO", "LIMITE_EXCEDIDO"),
                      "origem": ("APP", "WEB", "ATM")},
        windows=(1, 7, 30)),
    "churn": BookSpec(
        numeric=("valor_compras", "qtd_produtos"),
        ratios={"qtd_reclamacoes": "qtd_compras", "valor_desconto": "valor_total"},
        value_counts={"tipo_interacao": ("COMPRA", "RECLAMACAO", "CANCELAMENTO_TENTATIVA"),
                      "canal": ("ONLINE", "LOJA", "TELEFONE")},
        windows=(1, 3, 6, 12)),
}


def preset_book(df: DataFrame, name: str, ref: str,
                presets: Mapping[str, BookSpec] = BEHAVIOUR_PRESETS) -> DataFrame:
    """The book of a preset; an unknown name raises ``ValueError``."""
    if name not in presets:
        raise ValueError(f"unknown preset {name!r}; known: {sorted(presets)}")
    return feature_book(df, presets[name], ref)
