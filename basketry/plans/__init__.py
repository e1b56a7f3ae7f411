"""Jobs composed from the operators: cleaning, marts, RFM segmentation, the full run."""
