"""Command line: the experiments as runnable jobs.

    python -m cadenza prepare      DATA_DIR
    python -m cadenza unsupervised DATA_DIR [--n-init N]
    python -m cadenza supervised   DATA_DIR [--fit-on all|train]

DATA_DIR holds the per-artist track CSVs and the label file.  Results are
printed as tables (``show``); under ``spark-submit`` the cluster's master
and settings apply.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m cadenza")
    ap.add_argument("command", choices=["prepare", "unsupervised", "supervised"])
    ap.add_argument("data_dir")
    ap.add_argument("--n-init", type=int, default=10)
    ap.add_argument("--fit-on", choices=["all", "train"], default="all")
    ap.add_argument("--driver-memory", default="8g",
                    help="heap of a locally started driver (ignored when a session exists)")
    args = ap.parse_args(argv)

    from cadenza.plans import experiments
    from cadenza.session import get_spark
    spark = get_spark(app=f"cadenza-{args.command}",
                      extra={"spark.driver.memory": args.driver_memory})
    prep = experiments.prepare_training_data(spark, args.data_dir)
    prep["report"].show(truncate=False)
    print(f"features: {prep['features']}  rows after cleaning: {prep['df'].count()}")
    if args.command == "unsupervised":
        res = experiments.unsupervised_experiment(spark, prep, n_init=args.n_init)
        print(f"best k by silhouette: {res['best_k']}")
        res["summary"].orderBy("k").show()
        k = res["best_nmi_k"]
        print(f"cluster centroids (k={k}, original units)")
        res["profiles"][k].orderBy("cluster").show()
        print(f"cluster x genre (k={k})")
        res["crosstabs"][k].orderBy("cluster", F.desc("n")).show(200)
    elif args.command == "supervised":
        res = experiments.supervised_experiment(spark, prep, fit_on=args.fit_on)
        res["summary"].show()
        res["dropped"].show()
        res["comparison"].show()
        for name, rep in res["reports"].items():
            print(name)
            rep.show(200)
        print(f"feature importances ({res['best_model']})")
        res["importances"].show()


if __name__ == "__main__":
    main()
