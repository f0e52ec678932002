"""Operations on text corpora for language-model training: coding, de-duplication, filters, models, output, decontamination."""
