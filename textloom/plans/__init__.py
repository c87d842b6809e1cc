"""Whole jobs built from the operators."""

from textloom.plans.cleaning import clean_corpus, clean_corpus_two_stage, process_dataset
from textloom.plans.profiling import profile_lengths, profile_metrics
from textloom.plans.training import (
    evaluate, fit_text_classifier, load_model, prepare_training, run_training, save_model,
)
from textloom.plans.evaluation import evaluation_report, write_classification_report, write_metrics_json
from textloom.plans.scoring import score_texts, score_top5

__all__ = [
    "clean_corpus", "clean_corpus_two_stage", "process_dataset", "profile_lengths", "profile_metrics",
    "prepare_training", "fit_text_classifier", "run_training", "evaluate", "save_model", "load_model",
    "evaluation_report", "write_classification_report", "write_metrics_json", "score_top5", "score_texts",
]
