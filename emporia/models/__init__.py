"""MLlib feature pipelines, classifiers, clustering and evaluation tables."""
