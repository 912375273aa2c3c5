"""DataFrame-to-DataFrame operators over the card-fraud model."""
